"""Importance resampling against plain Python: CRCs, counts, gains, noise and ranks."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from linktide.llm.crc_grams import RunningCrcs, shift
from linktide.llm.importance import importance_sample, op13_importance_resampling

SF_DIR = "/root/testdata/sf0.001"


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def features(text):
    words = words_of(text)
    return [" ".join(words[k : k + n]) for n in (1, 2, 3) for k in range(len(words) - n + 1)]


def expected(docs, target, buckets=10_000, least=20, percent=5):
    """``[(doc_id, n_features, weight, score, rank)]`` of ``[(doc_id, text)]``."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in features(t))
    t = Counter(bucket(f) for x in target for f in features(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(
        1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))
    )
    rows = []
    for i, text in docs:
        found = features(text)
        weight = sum(gain(bucket(f)) for f in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(found), weight, weight + noise, len(words_of(text))))
    enough = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], -1 if r[0] is None else r[0], r[1]))
    order = {id(r): k + 1 for k, r in enumerate(enough[: percent * len(enough) // 100])}
    return [(*r[:4], order.get(id(r))) for r in rows]


def test_registered_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    rows = op13_importance_resampling(spark, SF_DIR)
    assert rows.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert Counter(map(tuple, rows.collect())) == Counter(expected(docs, target))


@given(st.lists(st.text("aAbé \n-9\0\U0001F600", max_size=40), max_size=6), st.integers(0, 600))
def test_crcs_of_all_runs(texts, long):
    raw = [t.encode() for t in [*texts, "q" * long + " r s " + "z" * (3 * long)]]
    data = np.frombuffer(b"".join(raw), np.uint8)
    crcs = RunningCrcs(data, np.cumsum([0, *map(len, raw)]))
    for n in (1, 2, 3, 5):
        k, found = crcs.grams(n)
        at, want = [], []
        for i, text in enumerate(raw):
            words = words_of(text.decode())
            assert len(words) == crcs.first[i + 1] - crcs.first[i]
            for j in range(len(words) - n + 1):
                at.append(crcs.first[i] + j)
                want.append(zlib.crc32(" ".join(words[j : j + n]).encode()))
        assert k.tolist() == at and found.tolist() == want


def test_long_shifts():
    heads, n = [b"abc", b"", b"xyz" * 40], [0, 70_000, 300]
    tails = [b"t" * k for k in n]
    moved = shift(np.array([zlib.crc32(h) for h in heads], np.uint32), np.array(n))
    assert [int(m) ^ zlib.crc32(t) for m, t in zip(moved, tails, strict=True)] == [
        zlib.crc32(h + t) for h, t in zip(heads, tails, strict=True)
    ]


def test_odd_rows(spark, make_docs, scratch, odd_texts):
    filler = [(1000 + k, " ".join(f"w{(k * j) % 50}" for j in range(1, 40))) for k in range(60)]
    repeated = [(2000, filler[3][1])] * 30
    docs = odd_texts + filler + repeated
    target = spark.createDataFrame([("w1 w2 w3 w4", 1), (None, 2), ("", 3), ("w1 w2 w3 w4", 1)], "text string, weight int")
    rows = importance_sample(make_docs(docs), target, scratch)
    got = [(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in rows.collect()]
    assert Counter(got) == Counter(expected(docs, ["w1 w2 w3 w4"] * 2))
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 1 + 5 * sum(len(words_of(t)) >= 20 for _, t in docs) // 100))


@pytest.mark.parametrize("empty", ["docs", "target"])
def test_empty_tables(make_docs, scratch, empty):
    some, none = make_docs([(1, "a b c " * 10), (2, "d")]), make_docs([])
    docs, target = (none, some) if empty == "docs" else (some, none)
    rows = importance_sample(docs, target, scratch, percent=100).collect()
    want = [] if empty == "docs" else expected([(1, "a b c " * 10), (2, "d")], [], percent=100)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in rows) == Counter(want)
