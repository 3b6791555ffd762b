"""Toxicity: segments against brute force, held-out accuracy, weights by hand, odd rows."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from linktide.llm import toxicity as t
from linktide.llm.segments import maximal_segments

SF_DIR = "/root/testdata/sf0.1"


def brute_segments(scores, at=0):
    """The best segment, shortest and leftmost on ties, then the same left and right of it."""
    best = max(
        ((sum(scores[i:j]), i - j, -i, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)),
        default=(0, 0, 0, 0, 0),
    )
    if best[0] <= 0:
        return []
    _, _, _, i, j = best
    return brute_segments(scores[:i], at) + [(at + i, at + j, best[0])] + brute_segments(scores[j:], at + j)


@given(st.lists(st.integers(-6, 6), max_size=14))
def test_segments_against_brute_force(scores):
    sums = np.concatenate([[0], np.cumsum(scores)]).astype(float)
    places = [i for i, s in enumerate(scores) if s > 0]
    assert maximal_segments(places, sums[places], sums[np.array(places, int) + 1]) == brute_segments(scores)


def test_segments_take_linear_time():
    scores = np.array([1.0, -1.5] * 200_000 + [1.0] * 200_000)
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    places = np.flatnonzero(scores > 0)
    found = maximal_segments(places.tolist(), sums[places], sums[places + 1])
    assert len(found) == 200_001 and found[-1] == (400_000, 600_000, 200_000.0)


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = t.op11_toxicity(spark, SF_DIR)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted", "n_passages"]
    rows = rows.join(labels, "doc_id", "left").collect()
    assert len(rows) == 10_000
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    tested = [r for r in rows if r.held_out and r.toxic is not None]
    caught = [r for r in tested if r.predicted]
    assert sum(r.toxic for r in caught) > 0.9 * len(caught)
    assert sum(r.toxic for r in caught) > 0.85 * sum(r.toxic for r in tested)


def planted(n=400):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{int(rng.paretovariate(0.7)) % 3000}" for _ in range(rng.randrange(20, 200))]
        if i % 5 == 0:
            k = rng.randrange(len(words) - 5)
            words[k : k + 4] = ["Vile", "foul", f"w{i}", "VILE"]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 5 == 0)))
    return rows, labels


def test_passages_and_weights(spark, make_docs, scratch):
    rows, labels = planted()
    docs = make_docs(rows)
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = t.toxic_passages(docs, labels, scratch).collect()
    texts = dict(rows)
    assert {r.doc_id for r in found} == {i for i, _ in rows if i % 5 == 0}
    passages = [(r.doc_id, texts[r.doc_id][r.start : r.end], r.e_value) for r in found]
    planted_ones = [(i, p) for i, p, _ in passages if "Vile foul" in p and "VILE" in p]
    assert {i for i, _ in planted_ones} == {i for i, _ in rows if i % 5 == 0}
    assert all(len(p.split()) <= 8 for _, p in planted_ones)  # a neighbour may have a weight as well
    assert len(passages) - len(planted_ones) <= 4 and all(e < 1e-4 for _, _, e in passages)
    # The counts and log-odds again, in plain Python.
    train = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5}
    counts = {k: Counter() for k in ("toxic", "clean", "all")}
    for i, text in rows:
        words = text.lower().split()
        words += [w[:4] + "-" for w in words if len(w) > 4]
        counts["all"].update(words)
        if i in train:
            counts["toxic" if i % 5 == 0 else "clean"].update(words)
    total = {k: c.total() for k, c in counts.items()}
    usual = t.PRIOR_SHARE * counts["all"]["vile"] / total["all"]
    a, b = (counts[k]["vile"] + usual * total[k] for k in ("toxic", "clean"))
    odds = np.log(a / total["toxic"]) - np.log(b / total["clean"])
    want = odds - t.DEVIATIONS * np.sqrt(1 / a + 1 / b)
    model, _ = t.fit_toxicity(docs, labels, scratch)
    data = np.frombuffer(b"ViLe", np.uint8)
    slot = t._Words(data, np.array([0, 4])).slots[0]
    assert model.weights[slot] == pytest.approx(want, abs=1 / t.STEPS)


def test_rate_is_a_root():
    gains, n_words = [(4.5, 3), (1.0, 80)], 50_000
    rate = t._rate(gains, n_words)
    sums = 3 * np.exp(4.5 * rate) + 80 * np.exp(rate) + np.exp(4.5 * rate) + (n_words - 83) * np.exp(-t.DRIFT * rate)
    assert rate > 0 and sums / (n_words + 1) == pytest.approx(1)


def test_stems(spark, make_docs, scratch):
    """Words of a toxic stem that no labelled text has."""
    rng = random.Random(6)
    rows = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(60))) for i in range(300)]
    rows = [(i, x + f" éblà{i} éblà{i}x" if i % 4 == 0 else x) for i, x in rows]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(250)], "doc_id long, quality int, toxic int")
    scores = {r.doc_id: r.score for r in t.toxicity_scores(make_docs(rows), labels, scratch).collect()}
    assert {i for i, s in scores.items() if s >= 0.5} == {i for i in range(300) if i % 4 == 0}


def test_odd_rows(spark, make_docs, scratch, odd_texts):
    rows, labels = planted(100)
    rows = [(1000 + i, x) for i, x in rows] + odd_texts + [(None, "vile foul"), (2000, "vile foul " * 20_000)]
    labels = [(1000 + i, q, x) for i, q, x in labels] + [(None, 1, 1), (5, 1, None), (6, 0, 0), (6, 1, 1), (99999, 1, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = t.toxicity_scores(make_docs(rows), labels, scratch)
    assert found.columns == ["doc_id", "held_out", "score", "n_passages"]
    got = found.collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert {r.held_out for r in got if r.doc_id is None} == {False}
    assert max(r.score for r in got) == next(r.score for r in got if r.doc_id == 2000) > 0.5
    assert t.toxicity_scores(make_docs([]), labels, scratch).collect() == []
    assert t.toxic_passages(make_docs([]), labels, scratch).collect() == []
    one_kind = labels.where("toxic = 0")
    assert {r.score for r in t.toxicity_scores(make_docs(rows), one_kind, scratch).collect()} == {0.0}
    assert t.toxic_passages(make_docs(rows), labels.where("false"), scratch).collect() == []
