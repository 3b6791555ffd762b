"""Every stage of the pipeline on what the one before kept, against brute force."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from linktide.llm.decontaminate import folded_words
from linktide.llm.token_output import word_bpe_path
from tests.llm.test_decontaminate import hits
from tests.llm.test_mixing import targets
from tests.llm.test_near_dedup import expected

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The rows before the first and after each stage, written and read again."""
    from __spark_entry__ import _ship

    _ship(spark)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, tables[-1], SF_DIR).write.parquet(path)
        tables.append(spark.read.parquet(path))
    assert all(t.columns == docs.columns for t in tables[:-1])
    return [t.collect() for t in tables]


def test_quality(spark, steps):
    before, after = ({r.doc_id: r for r in rows} for rows in steps[:2])
    assert all(before[i] == r for i, r in after.items())
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    good = [r.doc_id for r in labels if r.quality == 1]
    assert sum(i in after for i in good) > 0.95 * len(good) and len(after) < len(before)


def test_near_dedup(steps):
    rows = [(r.doc_id, r.text) for r in steps[1]]
    want = {r[0] for r, e in zip(rows, expected(rows, 5), strict=True) if e[3]}
    assert {r.doc_id for r in steps[2]} == want and len(want) == len(steps[2]) < len(rows)


def test_decontamination(spark, steps):
    items = [(r.item_id, folded_words(r.text)) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    after = {r.doc_id: r for r in steps[3]}
    for r in steps[2]:
        words = folded_words(r.text)
        places, _ = hits(words, items, 10)
        if len(places) > 0.5 * len(words):
            assert r.doc_id not in after
        elif places:
            left = [w for k, w in enumerate(words) if k not in places]
            assert folded_words(after[r.doc_id].text) == left
            assert after[r.doc_id].n_chars == len(after[r.doc_id].text)
        else:
            assert after[r.doc_id] == r


def test_mixing(steps):
    size = {r.doc_id: len((r.text or "").split()) for r in steps[3]}
    source = {r.doc_id: r.source for r in steps[3]}
    sizes, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, n in size.items():
        sizes[source[i]] += n
        most[source[i]] = max(most[source[i]], n)
    copies = Counter(r.doc_id for r in steps[4])
    assert max(copies.values()) <= 2
    for i, n in copies.items():
        taken[source[i]] += n * size[i]
    for name, want in targets(sizes).items():
        assert abs(taken[name] - want) <= most[name] / 2 + 1


def test_token_files(steps):
    tokenizer = Tokenizer.from_file(word_bpe_path())
    rows = sorted(steps[4], key=lambda r: (r.doc_id, r.text))
    at, want = 0, []
    for r in rows:
        n = len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1
        want.append((r.doc_id, at, n))
        at += n
    assert sorted((r.doc_id, r.start, r.n_tokens) for r in steps[5]) == want


def test_run(spark, steps):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(found.collect()) == sorted(steps[5])
