"""Quality classifier: held-out accuracy, prior, and odd rows; quality rules by hand."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from linktide.llm.quality import (
    FEATURES, PRIOR_SHARE, Model, _pass, _sums, bin_edges, fit, keep_good, op1_quality_classifier, quality_scores,
    text_features,
)
from linktide.llm.rules import RULES, Rule, quality_rules

SF_DIR = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = op1_quality_classifier(spark, SF_DIR)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = rows.join(labels, "doc_id", "left").collect()
    assert len(rows) == 10_000
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    tested = [r for r in rows if r.held_out and r.quality is not None]
    assert sum(r.predicted == r.quality for r in tested) > 0.97 * len(tested)
    good = [r for r in tested if r.quality == 1]
    assert sum(r.predicted for r in good) > 0.99 * len(good)


def test_odd_rows(spark, make_docs, scratch, odd_texts):
    labels = spark.createDataFrame(
        [(5, 1, 0), (5, 0, 0), (None, 1, 0), (7, 1, 1), (999, 1, 0)], "doc_id long, quality int, toxic int"
    )
    docs = make_docs(odd_texts)
    rows = quality_scores(docs, labels, scratch).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in odd_texts)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    kept = keep_good(docs, labels, threshold=0.0)
    assert kept.columns == docs.columns and kept.count() == len(odd_texts)
    nothing = labels.where("false")
    assert {r.score for r in quality_scores(docs, nothing, scratch).collect()} == {0.5}
    empty = make_docs([])
    assert quality_scores(empty, labels, scratch).collect() == [] and keep_good(empty, labels).count() == 0


def feature_rows(spark, n=600, share=0.3, seed=1):
    """Features of a mixture, ``share`` of them like the trusted rows, as numbers and as a table."""
    rng = np.random.default_rng(seed)
    good = rng.random(n) < share
    features = rng.normal(size=(n, len(FEATURES))).astype(np.float32)
    features[good] += np.linspace(0, 3, len(FEATURES)).astype(np.float32)
    trusted = good & (rng.random(n) < 0.4)
    rows = [(i, f.tolist(), bool(t)) for i, (f, t) in enumerate(zip(features, trusted, strict=True))]
    return features.astype(np.float64), good, trusted, spark.createDataFrame(
        rows, "doc_id long, features array<float>, trusted boolean"
    ).repartition(3)


def test_sums_and_risk_against_plain_numpy(spark):
    features, _, trusted, rows = feature_rows(spark)
    edges = bin_edges(rows)
    size = 1 + sum(len(e) + 1 for e in edges)
    weights = np.random.default_rng(2).normal(size=size) / 4
    model = Model(edges, weights, 0.3)
    design = np.zeros((len(features), size))
    for i, row in enumerate(features):
        at = 1
        design[i, 0] = 1
        for k, e in enumerate(edges):
            design[i, at + sum(x < row[k] for x in e)] = 1
            at += len(e) + 1
    s = _pass(rows, model, negative=True)
    sigma = 1 / (1 + np.exp(-design @ weights))
    n_u, n_p = len(features), trusted.sum()
    assert s["head"][:2].tolist() == [n_u, n_p]
    np.testing.assert_allclose(s["u1"], design.T @ sigma, rtol=1e-9)
    np.testing.assert_allclose(s["p1"], design[trusted].sum(axis=0))
    np.testing.assert_allclose(s["u2"].reshape(size, size), (design * (sigma * (1 - sigma))[:, None]).T @ design, rtol=1e-4, atol=1e-4)

    def risk(w):
        z = design @ w
        positive, negative = np.logaddexp(0, -z), np.logaddexp(0, z)
        return 0.3 * positive[trusted].mean() + negative.mean() - 0.3 * negative[trusted].mean()

    told = 0.3 * s["head"][4] / n_p + s["head"][2] / n_u - 0.3 * s["head"][3] / n_p
    assert told == pytest.approx(risk(weights))
    gradient = s["u1"] / n_u - 0.3 * s["p1"] / n_p
    for k in range(0, size, 17):
        step = np.zeros(size)
        step[k] = 1e-5
        assert gradient[k] == pytest.approx((risk(weights + step) - risk(weights - step)) / 2e-5, abs=1e-7)


@pytest.mark.parametrize("share", [0.2, 0.6])
def test_prior_and_fit_of_a_mixture(spark, share):
    features, good, _, rows = feature_rows(spark, n=4000, share=share, seed=5)
    model = fit(rows)
    assert model.prior / PRIOR_SHARE == pytest.approx(share, abs=0.08)
    found = model.scores(features) >= 0.5
    assert (found == good).mean() > 0.93


def test_many_partitions_are_added_up(spark):
    features, _, _, rows = feature_rows(spark)
    sums = [_sums(rows.repartition(n), lambda b: np.array([len(b), 1.0 * sum(b["doc_id"].to_pylist())]), 2) for n in (1, 200)]
    assert sums[0].tolist() == sums[1].tolist() == [600, 600 * 599 / 2]


def test_features_of_no_words():
    assert text_features(np.frombuffer(b" \n\t", np.uint8)) == [0.0] * len(FEATURES)


def measured(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {p for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for p in range(i, i + 5)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)), len(inside),
        len(words) < 10 or 100 * len(inside) > 20 * len(words),
    )


def test_rules_against_plain_python(make_docs, odd_texts):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abé") for _ in range(rng.randrange(60))) + rng.choice(["", "\nx\nx\n \nx"]) for _ in range(60)]
    rows = odd_texts + [(100 + k, t) for k, t in enumerate(texts)] + [(300, "## | <b> the \r\n the\x0b and" * 9)]
    found = quality_rules(make_docs(rows))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = Counter((r.doc_id, *(r[n] for n in names)) for r in found.collect())
    assert got == Counter((i, *measured(t)) for i, t in rows)
    assert found.where("base_failed and kept").count() == 0
    assert quality_rules(make_docs([])).collect() == []


def test_a_rule_of_ones_own(make_docs):
    text = "the quick brown fox and the lazy dog ran far away"
    docs = make_docs([(1, text), (2, text + " |a |b |c |d |e |f")])
    own = (*RULES, Rule("n_words", most=15))
    rows = {r.doc_id: (r.failed, r.kept) for r in quality_rules(docs, own).collect()}
    assert rows == {1: ([], True), 2: (["symbol_ratio", "n_words"], False)}
    assert quality_rules(docs, ()).agg(F.min("kept")).first()[0]
    plan = quality_rules(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange hash" not in plan


def test_stop_words_are_a_share_of_all_words(make_docs):
    words = [f"word{k}" for k in range(95)]
    docs = make_docs([(k, " ".join([*words, *["The"] * k, "ze"])) for k in (1, 4, 5, 6)])
    found = {r.doc_id: (round(r.stop_ratio, 3), "stop_ratio" in r.failed) for r in quality_rules(docs, RULES).collect()}
    assert found == {1: (0.01, True), 4: (0.04, True), 5: (0.05, True), 6: (0.059, False)}


@pytest.mark.parametrize("n", [6, 5000])
def test_rules_on_long_repeats(make_docs, n):
    row = quality_rules(make_docs([(1, "one two three four five six " * n)])).first()
    assert row.n_repeat_words == row.n_words == 6 * n
