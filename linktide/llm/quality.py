"""Quality classifier by non-negative positive-unlabelled learning."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linktide.llm.common import SPACE, plain_names, table, text_blocks
from linktide.scratch import Scratch

THRESHOLD = 0.3
FOLDS = 5
RIDGE = 2e-3
# The share of the estimated prior that the risk uses. Where the prior is too high for a
# region of the texts, the unbiased risk falls without end there.
PRIOR_SHARE = 0.9
ROUNDS = 12
QUANTILES = (0.01, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.95, 0.98, 0.99)
SCORE_BINS = 400

FEATURES = (
    "log_words", "word_bytes", "longest_word", "upper", "digits", "signs", "stops", "shouts",
    "non_ascii", "short_words", "fresh_words", "repeats", "bare_words", "line_words", "fresh_lines",
)
_UPPER, _DIGITS = slice(65, 91), slice(48, 58)
_STOPS = [ord(c) for c in ".,;:'\"-"]
_SHOUTS = [ord(c) for c in "!?"]
_SIGNS = [b for b in range(33, 127) if not chr(b).isalnum() and b not in _STOPS + _SHOUTS]


def text_features(raw: np.ndarray) -> list[float]:
    """The features of one text's UTF-8 bytes; all zero for a text without words."""
    data = raw.tobytes()
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(raw, minlength=256)
    n, size = len(words), len(data) - int(counts[SPACE].sum())
    lengths = np.fromiter(map(len, words), np.int64, n)
    chunks = [words[k : k + 50] for k in range(0, n, 50)]
    fresh = sum(len(set(c)) for c in chunks) / n
    repeats = sum(map(bytes.__eq__, words[1:], words[:-1])) / n
    lines = [line for line in data.split(b"\n") if not line.isspace() and line]
    return [
        np.log1p(n), size / n, np.log1p(lengths.max()), counts[_UPPER].sum() / size,
        counts[_DIGITS].sum() / size, counts[_SIGNS].sum() / size, counts[_STOPS].sum() / size,
        counts[_SHOUTS].sum() / size, counts[128:].sum() / size, (lengths <= 3).sum() / n, fresh,
        repeats, (lengths == 1).sum() / n, np.log1p(n / len(lines)), len(set(lines)) / len(lines),
    ]


def feature_table(docs: DataFrame) -> DataFrame:
    """``(doc_id, features)`` of whole texts; nothing but the text is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_blocks(batches, "text"):
            found = [text_features(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(found, pa.list_(pa.float32()))], ["doc_id", "features"]
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, features array<float>")


@dataclass(frozen=True)
class Model:
    """An additive logistic model over binned features."""

    edges: tuple[np.ndarray, ...]
    weights: np.ndarray
    prior: float

    @property
    def size(self) -> int:
        return 1 + sum(len(e) + 1 for e in self.edges)

    def columns(self, features: np.ndarray) -> np.ndarray:
        """``(rows, features + 1)``: the places that are 1 in each row's design vector."""
        at, places = 1, [np.zeros(len(features), np.int64)]
        for k, edges in enumerate(self.edges):
            places.append(at + np.searchsorted(edges, features[:, k], "left"))
            at += len(edges) + 1
        return np.stack(places, axis=1)

    def margins(self, features: np.ndarray) -> np.ndarray:
        return self.weights[self.columns(features)].sum(axis=1)

    def scores(self, features: np.ndarray) -> np.ndarray:
        return _sigmoid(self.margins(features))

    def with_weights(self, weights: np.ndarray) -> Model:
        return Model(self.edges, weights, self.prior)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column("features")
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1).astype(np.float64)


def _sums(rows: DataFrame, of_batch: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """The sum of ``of_batch`` over all rows: per task, then per group of tasks."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if len(batch):
                total += of_batch(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if len(batch):
                total += batch.column("sums").flatten().to_numpy().reshape(len(batch), size).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["sums"])

    parts = rows.mapInArrow(task, "sums array<double>")
    n = parts.rdd.getNumPartitions()
    while n > 64:  # the driver gets 64 rows at most
        n = max(1, int(n**0.5))
        parts = parts.repartition(n).mapInArrow(add, "sums array<double>")
    # One job for all tasks; what the driver gets is bounded by the step before.
    return parts.toArrow().column("sums").combine_chunks().flatten().to_numpy().reshape(-1, size).sum(axis=0)


def bin_edges(features: DataFrame) -> tuple[np.ndarray, ...]:
    """Quantiles of every feature over all rows; equal ones are one edge."""
    columns = [
        F.percentile_approx(F.col("features")[k], list(QUANTILES), 10_000).alias(name)
        for k, name in enumerate(FEATURES)
    ]
    found = features.agg(*columns).first()
    return tuple(np.unique(np.array(found[name] or [], np.float64)) for name in FEATURES)


def _design(places: np.ndarray, weights: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Weighted sums of design vectors and of their outer products (places are ones)."""
    first = np.zeros(size)
    second = np.zeros((size, size))
    for k in range(places.shape[1]):
        np.add.at(first, places[:, k], weights)
    dense = np.zeros((len(places), size), np.float32)
    dense[np.arange(len(places))[:, None], places] = 1
    second += (dense * weights[:, None].astype(np.float32)).T @ dense
    return first, second.ravel()


def _pass(rows: DataFrame, model: Model, negative: bool) -> dict[str, np.ndarray]:
    """One pass: losses, gradient and curvature sums of unlabelled and trusted rows.

    ``negative``: curvature of the unlabelled rows alone, as in the unbiased risk; else of
    both groups, as in telling trusted from unlabelled rows.
    """
    size = model.size

    def of_batch(batch: pa.RecordBatch) -> np.ndarray:
        features, trusted = _matrix(batch), batch.column("trusted").to_numpy(zero_copy_only=False)
        total = np.zeros(8 + 3 * size + 2 * size * size)
        for k in range(0, len(features), 4096):
            part, p = features[k : k + 4096], trusted[k : k + 4096].astype(np.float64)
            places = model.columns(part)
            z = model.weights[places].sum(axis=1)
            s = _sigmoid(z)
            u1, u2 = _design(places, s, size)[0], _design(places, s * (1 - s), size)[1]
            p1 = np.bincount(places.ravel(), np.repeat(p, places.shape[1]), size)
            p1s = np.bincount(places.ravel(), np.repeat(p * s, places.shape[1]), size)
            p2 = _design(places[p > 0], (s * (1 - s))[p > 0], size)[1] if not negative else np.zeros(size * size)
            soft, softm = np.logaddexp(0, z), np.logaddexp(0, -z)
            head = [len(part), p.sum(), soft.sum(), (p * soft).sum(), (p * softm).sum(), 0, 0, 0]
            total += np.concatenate([head, u1, p1, p1s, u2, p2])
        return total

    total = _sums(rows, of_batch, 8 + 3 * size + 2 * size * size)
    body = np.split(total[8:], np.cumsum([size, size, size, size * size]))
    return dict(zip(("u1", "p1", "p1s", "u2", "p2"), body, strict=True), head=total[:8])


def _told_apart(rows: DataFrame, model: Model, rounds: int, ridge: float) -> Model:
    """Trusted against unlabelled rows, both groups weighing the same."""
    for _ in range(rounds):
        s = _pass(rows, model, negative=False)
        n_u, n_p = max(1.0, s["head"][0]), max(1.0, s["head"][1])
        gradient = s["u1"] / n_u - (s["p1"] - s["p1s"]) / n_p
        curvature = (s["u2"] / n_u + s["p2"] / n_p).reshape(model.size, -1) + np.diag(np.full(model.size, ridge))
        step = np.linalg.solve(curvature, gradient + ridge * model.weights)
        model = model.with_weights(model.weights - step)
    return model


def estimate_prior(rows: DataFrame, model: Model, delta: float = 0.1) -> float:
    """The share of positives among unlabelled rows, by the best bin of a ranking score.

    In the purest top bin, the unlabelled rows are all positive, so the ratio of the two
    groups' shares there is the prior; the bin with the least upper bound is taken.
    """
    def of_batch(batch: pa.RecordBatch) -> np.ndarray:
        s = np.minimum((model.scores(_matrix(batch)) * SCORE_BINS).astype(int), SCORE_BINS - 1)
        p = batch.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
        return np.concatenate([np.bincount(x, minlength=SCORE_BINS) for x in (s, s[p])]).astype(float)

    u, p = np.split(_sums(rows, of_batch, 2 * SCORE_BINS), 2)
    n_u, n_p = u.sum(), p.sum()
    if not n_p:
        return 0.5
    top_u, top_p = u[::-1].cumsum() / n_u, p[::-1].cumsum() / n_p
    slack = np.sqrt(np.log(4 / delta) / 2 / n_u) + np.sqrt(np.log(4 / delta) / 2 / n_p)
    seen = top_p > 0
    best = np.argmin((top_u[seen] + slack) / top_p[seen])
    return float(np.clip(top_u[seen][best] / top_p[seen][best], 0.01, 0.99))


def fit(rows: DataFrame, *, rounds: int = ROUNDS, ridge: float = RIDGE) -> Model:
    """Minimise the non-negative unbiased risk over ``rows(doc_id, features, trusted)``.

    All rows are unlabelled text; the ``trusted`` ones are positives too. With logistic
    loss and class prior p the risk is ``p E+[loss(+)] + max(0, E[loss(-)] - p E+[loss(-)])``.
    While the second part is positive its Newton steps need the trusted rows only through
    their mean; a step that makes the risk rise, or the second part negative, is taken back
    and damped. Every pass covers all rows. Without trusted rows the model is flat at one half.
    """
    edges = bin_edges(rows)
    model = Model(edges, np.zeros(1 + sum(len(e) + 1 for e in edges)), 0.5)
    # One half of the trusted rows ranks, the other half is looked up in the ranking.
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)) == 0
    ranking = _told_apart(rows.withColumn("trusted", F.col("trusted") & half), model, 3, 10 * ridge)
    prior = estimate_prior(rows.withColumn("trusted", F.col("trusted") & ~half), ranking)
    prior *= PRIOR_SHARE
    model = Model(edges, np.zeros(model.size), prior)
    best, damping = None, ridge
    for _ in range(rounds):
        s = _pass(rows, model, negative=True)
        n_u, n_p = s["head"][0], s["head"][1]
        if not n_p:
            return model
        negative = s["head"][2] / n_u - prior * s["head"][3] / n_p
        penalty = ridge / 2 * float(model.weights @ model.weights)
        risk = prior * s["head"][4] / n_p + max(0.0, negative) + penalty
        if best is None or (risk <= best[0] and negative >= 0):
            done = best is not None and best[0] - risk < 1e-4 * risk
            gradient = s["u1"] / n_u - prior * s["p1"] / n_p + ridge * model.weights
            best = (risk, model.weights, gradient, s["u2"].reshape(model.size, -1) / n_u)
            if done:
                break
        else:  # the step went too far: a shorter one, turned towards the gradient
            damping *= 8
        curvature = best[3] + np.diag(np.full(model.size, damping))
        model = model.with_weights(best[1] - np.linalg.solve(curvature, best[2]))
    return model.with_weights(best[1])


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _trained(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> tuple[Model | None, DataFrame]:
    """The model (None for an empty table) and the stored features of all documents."""
    trusted = labels.where("quality = 1").select(F.col("doc_id").cast("long")).distinct()
    features = feature_table(docs).withColumn("held_out", held_out())
    trusted = trusted.where(~held_out()).withColumn("trusted", F.lit(True))
    rows = features.join(trusted, "doc_id", "left").withColumn("trusted", F.coalesce("trusted", F.lit(False)))
    rows, seen = scratch.save(rows, "features", {"n": F.count(F.lit(1))})
    return fit(rows) if seen["n"] else None, rows


def quality_scores(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """``(doc_id, held_out, score)``, one row per row of ``docs``.

    Trusted positives are the documents with a label 1 whose doc_id is not held out
    (crc32 of the doc_id as text modulo 5 is 0); every other document is unlabelled text,
    and label 0 is not used at all. Scores are read from the text alone, so equal texts
    score the same, null and empty ones like a text without words. A document with
    several labels is trusted if one is 1. A null doc_id has no label and is not held
    out. An empty table gives an empty result; other columns are ignored.
    """
    model, rows = _trained(docs, labels, scratch)
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(0.5).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"), pa.array(model.scores(_matrix(batch)))],
                    ["doc_id", "held_out", "score"],
                )

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all columns.

    Texts are scored again where they are, so that only features are stored and no text
    is moved to be filtered; the features go once the model is fitted. Null, empty and
    wordless texts score like each other and are judged by that score; repeated rows and
    null doc_ids are judged by their text. An empty table stays empty.
    """
    with Scratch(docs.sparkSession) as scratch:
        model, _ = _trained(docs, labels, scratch)
    if model is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_blocks(batches, "text"):
            found = [text_features(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            scores = model.scores(np.array(found, np.float32).astype(np.float64))
            yield rows.filter(pa.array(scores >= threshold))

    plain = plain_names(docs)
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scores = quality_scores(docs, labels, Scratch(spark))
    return scores.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
