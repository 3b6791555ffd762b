"""Suffix arrays and removed passages against plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linktide.llm.suffix_dedup import cut_texts, op4_suffix_dedup, repeated_spans
from linktide.llm.suffix_order import suffix_array


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60) | st.lists(st.integers(1, 200), max_size=60))
def test_suffix_array(symbols):
    text = [*symbols, 0]
    assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def expected(texts, length):
    windows = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    found = []
    for t in texts:
        covered = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if windows[t[i : i + length]] > 1:
                covered[i : i + length] = b"\x01" * length
        spans, at = [], 0
        while at < len(t):
            end = at
            while end < len(t) and covered[end] == covered[at]:
                end += 1
            if covered[at]:
                spans.append((at, end))
            at = end
        found.append((spans, bytes(b for b, c in zip(t, covered, strict=True) if not c)))
    return found


def passages(seed, length):
    """Copies, shared passages in many contexts, inner repeats and runs of one letter."""
    rng = random.Random(seed)

    def text(n):
        return "".join(rng.choice("abé ") for _ in range(n))

    shared, half = text(length * 2), text(length - 7)
    rows = [text(rng.randrange(4 * length)) + shared + text(rng.randrange(length)) for _ in range(30)]
    rows += [text(30) + half + text(rng.randrange(9, 60)) for _ in range(30)]
    rows += [rows[0]] * 3 + [text(length) * 2 + "é", "a" * (3 * length), "a" * (length - 1), "b" * length, ""]
    near = list(text(3 * length))
    for _ in range(20):
        near[rng.randrange(len(near))] = "#"
        rows.append("".join(near))
    return rows


@pytest.mark.parametrize("length, group_rows", [(40, 1000), (40, 3), (64, 5)])
def test_against_all_windows(make_docs, scratch, length, group_rows):
    texts = [None, *passages(length, length)]
    rows = [(k % 70 if k % 9 else None, t) for k, t in enumerate(texts)]
    docs = make_docs(rows)
    found, spans = repeated_spans(docs, scratch, length=length, group_rows=group_rows)
    kept = {bytes(r.text_id): bytes(r.kept) for r in cut_texts(docs, found, spans, scratch).collect()}
    spans = {bytes(r.text_id): [(s.start, s.end) for s in r.spans] for r in spans.collect()}
    raw = [(t or "").encode() for t in texts]
    for t, (want, left) in zip(raw, expected(raw, length), strict=True):
        name = hashlib.sha256(t).digest()
        assert spans.get(name, []) == want
        assert kept.get(name, t) == left
    sizes = found.select("doc_id", "n_bytes").collect()
    assert Counter((r.doc_id, r.n_bytes) for r in sizes) == Counter((i, len((t or "").encode())) for i, t in rows)


def test_periodic_texts(make_docs, scratch):
    """Short periods, each text's windows in others as well, once and more often."""
    units = ["=", "ab", "-=", "xyz ", "é", "0123456789abcdef", "0123456789abcdefg", "aab" * 7 + "c"]
    texts = [u * (400 // len(u)) for u in units] + [u * 45 for u in units[:5]]
    texts += ["k" + "=" * 64 + "q", "=" * 63, "head " + "ab" * 40 + " tail " + "xyz " * 17, "ab" * 32 + "!", "=" * 64]
    rows = list(enumerate(texts))
    found, spans = repeated_spans(make_docs(rows), scratch, length=64)
    names = {bytes(r.text_id): r.doc_id for r in found.collect()}
    got = {names[bytes(r.text_id)]: [(s.start, s.end) for s in r.spans] for r in spans.collect()}
    for (i, _), (want, _) in zip(rows, expected([t.encode() for t in texts], 64), strict=True):
        assert got.get(i, []) == want, i


def test_a_long_text_of_one_byte(spark, make_docs, scratch):
    docs = make_docs([(1, "-" * 1_000_000), (2, "ab" + "-" * 400 + "cd"), (3, "ef" + "-" * 399 + "gh")])
    found, spans = repeated_spans(docs, scratch)
    runs = {r.doc_id: len(r.lows) for r in spark.read.parquet(f"{scratch.folder}/000_runs").collect()}
    assert runs[1] == 1  # not one per byte
    names = {bytes(r.text_id): r.doc_id for r in found.collect()}
    got = {names[bytes(r.text_id)]: [(s.start, s.end) for s in r.spans] for r in spans.collect()}
    assert got == {1: [(0, 1_000_000)], 2: [(2, 402)]}


def test_a_group_in_many_surroundings(make_docs, scratch):
    """One passage between letters of its own in each of many texts, ordered in one group."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    passage = word(45)
    texts = [word(rng.randrange(40)) + passage + word(rng.randrange(40)) for _ in range(300)]
    found, spans = repeated_spans(make_docs(list(enumerate(texts))), scratch, length=40)
    names = {bytes(r.text_id): r.doc_id for r in found.collect()}
    got = {names[bytes(r.text_id)]: [(s.start, s.end) for s in r.spans] for r in spans.collect()}
    for i, (want, _) in enumerate(expected([t.encode() for t in texts], 40)):
        assert got.get(i, []) == want


def test_odd_texts_and_no_rows(make_docs, scratch, odd_texts):
    rows, spans = repeated_spans(make_docs(odd_texts), scratch)
    assert rows.count() == len(odd_texts)
    removed = rows.join(spans, "text_id").select("doc_id", "n_bytes", F.size("spans").alias("n"), "spans").collect()
    whole = {r.doc_id for r in removed if r.n == 1 and r.spans[0].start == 0 and r.spans[0].end == r.n_bytes}
    assert whole == {5, 6, 8, 9} and len(removed) == 4
    rows, spans = repeated_spans(make_docs([]), scratch)
    assert rows.collect() == [] and spans.collect() == []
    with pytest.raises(ValueError, match="passages"):
        repeated_spans(make_docs([]), scratch, length=5)


def test_shared_passages_go_by_bytes_and_not_by_words(spark, make_docs, tmp_path):
    """Passages of over 50 words between two texts: 399 bytes stay, 400 and more go whole."""
    rng, rows, want = random.Random(3), [], {}
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    sizes = [(51, 300), (55, 399), (55, 400), (90, 399), (90, 400), (120, 700)]
    for k, (n_words, size) in enumerate(sizes):
        letters = size - (n_words - 1)
        passage = " ".join(word(letters // n_words + (i < letters % n_words)) for i in range(n_words))
        assert (len(passage), len(passage.split())) == (size, n_words)
        for i, (a, b) in ((2 * k, "()"), (2 * k + 1, "[]")):  # nothing around it in common
            head, tail = word(40) + a, b + word(40)
            rows.append((i, head + passage + tail))
            kept = head + tail if size >= 400 else head + passage + tail
            want[i] = (size + 82, size + 82 - len(kept), int(size >= 400), hashlib.sha256(kept.encode()).hexdigest())
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = op4_suffix_dedup(spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == want
