"""The registered queries: SQL where there is some, and the promised columns."""

from __future__ import annotations

import hashlib
import struct
import zlib
from pathlib import Path

import duckdb
import pytest
from tokenizers import Tokenizer

from linktide.llm.queries import ORACLE_SQL, QUERIES
from linktide.llm.token_output import word_bpe_path
from tests.llm.test_near_dedup import expected
from tests.llm.test_spans import PII, SECRETS, found
from tests.llm.test_suffix_dedup import expected as expected_passages

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_quality_classifier": "doc_id held_out score predicted",
    "op2_token_files": "doc_id start n_tokens ids_crc32",
    "op9_token_counts": "doc_id section start end n_tokens n_crossing",
    "op11_toxicity": "doc_id held_out score predicted n_passages",
}


def by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(row[i] for i in order) for row in rows)


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    return {r.doc_id: r.text for r in rows}


def test_every_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    duck = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        duck.execute(f"create view {path.stem} as select * from '{path}'")
    result = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLE_SQL[name])
    want = by_name([d[0] for d in cursor.description], cursor.fetchall())
    assert by_name(result.columns, result.collect()) == want and want[1]


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, texts, name):
    result = QUERIES[name](spark, SF_DIR)
    assert result.columns == COLUMNS[name].split()
    assert {r.doc_id for r in result.select("doc_id").collect()} == set(texts)


def test_token_files(spark, texts):
    tokenizer, at, want = Tokenizer.from_file(word_bpe_path()), 0, []
    for i, text in sorted(texts.items()):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((i, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    assert sorted(map(tuple, QUERIES["op2_token_files"](spark, SF_DIR).collect())) == want


def test_token_counts(spark, texts):
    """Each token of the library goes to the line that holds most of its characters."""
    import public_tokenizers

    tokenizer, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), []
    tokenizer.encode_special_tokens = True
    for i, text in texts.items():
        lines, at = [], 0
        for line in text.splitlines(keepends=True) if set(text) <= set(map(chr, range(0x20, 0x250))) | {"\n"} else []:
            lines.append([at, at + len(line), 0, 0])
            at += len(line)
        if at != len(text) or not lines:
            continue  # other line ends than \n: left to the tests of the parts
        for a, b in tokenizer.encode(text, add_special_tokens=False).offsets:
            shared = [min(b, line[1]) - max(a, line[0]) for line in lines]
            own = lines[shared.index(max(shared))]
            own[2] += 1
            own[3] += a < own[0] or b > own[1]
        want += [(i, k, *line) for k, line in enumerate(lines)]
    told = {w[0] for w in want}
    rows = [tuple(r) for r in QUERIES["op9_token_counts"](spark, SF_DIR).collect() if r.doc_id in told]
    assert sorted(rows) == sorted(want) and len(told) > 0.8 * len(texts)


def test_passages(spark, texts):
    rows = {r.doc_id: r for r in QUERIES["op4_suffix_dedup"](spark, SF_DIR).collect()}
    raw = {i: t.encode() for i, t in texts.items()}
    for (i, t), (spans, kept) in zip(raw.items(), expected_passages(list(raw.values()), 400), strict=True):
        r = rows[i]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(t), len(t) - len(kept), len(spans))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_near_duplicates(spark, texts):
    rows = QUERIES["op8_minhash_near_dedup"](spark, SF_DIR)
    assert rows.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, rows.collect())) == sorted(expected(list(texts.items()), 4))


@pytest.mark.parametrize(
    "name, patterns, by_start",
    [("op7_personal_data", PII, False), ("op10_secret_scan", SECRETS, True)],
)
def test_spans(spark, texts, name, patterns, by_start):
    for r in QUERIES[name](spark, SF_DIR).collect():
        want = found(texts[r.doc_id], patterns, by_start)
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(r.spans.split(","))  or not want
        assert [r[f"n_{k}"] for k, _ in patterns] == [sum(w.startswith(k) for w in want) for k, _ in patterns]
