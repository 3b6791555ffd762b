"""Token files and token counts against the libraries."""

from __future__ import annotations

import io
import random
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from linktide.llm.encoding import TextEncoder
from linktide.llm.token_counts import (
    attributed, byte_bpe_path, count_tokens, line_sections, token_spans,
)
from linktide.llm.token_file import TokenFile, pack
from linktide.llm.token_output import (
    document_digests, read_token_files, word_bpe_path, write_token_files,
)

TEXTS = [
    "", "  ", "it's we'll 'S x''s don't", "<|endoftext|> hi", "naïve ÀÉÎ ß ÿ 12 3a4 !!'s--", "日本語 text",
    "éa", "a b\x0bc", "\x1c x", "don'tt 're're", "'" * 5 + "s", "İstanbul", "×÷ 3", "a<b|c <|x",
    "Tab\tand\r\nline", "word " * 500 + "Übung", "x" * 3000,
]


def encoded(encoder, texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return encoder.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)


@pytest.mark.parametrize("table_words", [3, 1_000_000])
def test_ids_are_those_of_the_library(table_words):
    encoder = TextEncoder(word_bpe_path(), table_words)
    assert encoder.by_word
    for _ in range(2):
        want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in TEXTS]
        assert [ids.tolist() for ids in encoded(encoder, TEXTS)] == want


ENCODER = TextEncoder(word_bpe_path(), 50)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("abT É'ß.,!9\n\t<|é日-"), max_size=25), max_size=6))
def test_ids_of_any_text(texts):
    want = [ENCODER.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in encoded(ENCODER, texts)] == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=700), max_size=5))
def test_file_round_trip(documents):
    arrays = [np.array(d, np.uint32) for d in documents]
    names = [None if k == 1 else k - 3 for k in range(len(arrays))]
    stored = TokenFile(io.BytesIO(pack(names, arrays)))
    flat = [i for d in documents for i in d]
    assert stored.index()[0] == names
    assert [stored.document(k).tolist() for k in range(len(arrays))] == documents
    rng = random.Random(0)
    for _ in range(20 if flat else 0):
        a = rng.randrange(len(flat))
        b = rng.randrange(a, len(flat) + 1)
        assert stored.id(a) == flat[a] and stored.ids(a, b).tolist() == flat[a:b]
    with pytest.raises(IndexError):
        stored.ids(0, len(flat) + 1)


@pytest.mark.parametrize("file_ids", [50, 16_000_000])
def test_files_of_a_table(make_docs, scratch, odd_texts, file_ids):
    rows = odd_texts + [(20 + k, t) for k, t in enumerate(TEXTS)]
    folder = scratch.path("tokens")
    manifest = write_token_files(make_docs(rows), folder, word_bpe_path(), scratch, file_ids=file_ids)
    tokenizer = Tokenizer.from_file(word_bpe_path())
    want, at = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((doc_id, at, ids))
        at += len(ids)
    found = read_token_files(manifest).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.ids) for r in found] == want
    digests = document_digests(manifest).orderBy("start").collect()
    sums = [(d, s, len(i), zlib.crc32(struct.pack(f"<{len(i)}I", *i))) for d, s, i in want]
    assert [tuple(r) for r in digests] == sums
    assert (manifest.count() > 5) == (file_ids == 50)


def test_no_documents(make_docs, scratch):
    manifest = write_token_files(make_docs([]), scratch.path("tokens"), word_bpe_path(), scratch)
    assert document_digests(manifest).collect() == []


def test_offsets_are_those_of_the_library():
    import public_tokenizers

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    for text in [*TEXTS, "a\n\n\nb \n c", "\n\n", "日本語\n\U0001F600\U0001F600 x\n", " " * 3000, "é\n" * 50]:
        starts, ends = token_spans(text.encode(), byte_bpe_path())
        offsets = library.encode(text, add_special_tokens=False).offsets
        assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == [tuple(o) for o in offsets]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5), max_size=12), st.lists(st.tuples(st.integers(0, 3), st.integers(1, 6)), max_size=6))
def test_rule_for_crossing_tokens(sizes, parts):
    ends = np.cumsum(np.array(sizes, np.int64))
    starts = ends - np.array(sizes, np.int64)
    sections, at = [], 0
    for gap, size in parts:
        sections.append((None, at + gap, at + gap + size))
        at += gap + size
    count, crossing, outside = [0] * len(sections), [0] * len(sections), 0
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        shared = [max(0, min(b, h) - max(a, low)) for _, low, h in sections]
        if not any(shared):
            outside += 1
            continue
        k = shared.index(max(shared))
        count[k] += 1
        crossing[k] += a < sections[k][1] or b > sections[k][2]
    found = attributed(starts, ends, sections)
    assert (found[0].tolist(), found[1].tolist(), found[2]) == (count, crossing, outside)


def test_sections_of_a_table(make_docs, odd_texts):
    rows = count_tokens(make_docs(odd_texts)).collect()
    for doc_id, text in odd_texts:
        raw = (text or "").encode()
        own = sorted(r.section for r in rows if r.doc_id == doc_id)
        assert own[:1] == [0]
        if doc_id in (1, 2, 3, 5, 8, 9):
            assert len(own) == len(line_sections(raw))
            assert sum(r.n_tokens for r in rows if r.doc_id == doc_id) == len(token_spans(raw, byte_bpe_path())[0])
    assert count_tokens(make_docs([])).collect() == []


def test_given_fields(make_docs):
    part = F.struct(F.lit("head").alias("name"), F.lit(0).alias("start"), F.lit(5).alias("end"))
    rows = count_tokens(make_docs([(1, "hello wonderful world"), (2, None)]), sections=F.array(part, F.lit(None))).collect()
    assert {(r.doc_id, r.section, r.name, r.n_tokens) for r in rows} == {
        (1, 0, "head", 1), (1, -1, None, 2), (2, 0, "head", 0),
    }
    over = F.array(part, F.struct(F.lit("b").alias("name"), F.lit(3).alias("start"), F.lit(9).alias("end")))
    with pytest.raises(Exception, match="sections overlap"):
        count_tokens(make_docs([(1, "x")]), sections=over).collect()
