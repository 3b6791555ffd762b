"""Toxic passages by maximal scoring segments of token log-odds."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linktide.llm.common import mixed, span_hashes, table, text_blocks, word_spans
from linktide.llm.crc_grams import FOLD
from linktide.llm.membership import IdFilter
from linktide.llm.quality import held_out
from linktide.llm.segments import maximal_segments
from linktide.scratch import Scratch

THRESHOLD = 0.5
# Words and stems share 2 ** SLOT_BITS slots by hash, so the table of weights has a fixed
# size (4 MB) whatever the corpus holds; more bits separate more words.
SLOT_BITS = 20
# A word without a weight of its own is judged by its first characters.
STEM_CHARS = 4
# Prior words of either class, as a share of its labelled words; they are dealt over slots
# like the words of all documents.
PRIOR_SHARE = 0.02
# Log-odds are moved towards 0 by so many standard deviations.
DEVIATIONS = 1.0
# What every word costs, so that scores fall on clean text. With weights in steps of
# 1/1024 all sums are exact, wherever a text stands.
DRIFT = 0.5
STEPS = 1024
# The share of clean segments below the threshold that the law of their scores begins at.
TAIL = 0.9
BINS, BIN_WIDTH = 400, 0.25


@dataclass(frozen=True)
class ToxicModel:
    """Word weights, the extreme-value law of segment scores on clean text, and two weights
    that turn a text's evidence into a probability."""

    weights: np.ndarray  # float32, one per slot
    rate: float  # lambda of the extreme-value law
    log_k: float
    intercept: float
    slope: float

    def e_value(self, score: Column, n_words: Column) -> Column:
        """How many segments with this score a clean text of this length is expected to have."""
        return F.exp(F.lit(self.log_k) + F.log(n_words.cast("double")) - F.lit(self.rate) * score)

    def evidence(self) -> Column:
        """The sum of ``-ln E`` over a text's segments with an expectation below 1."""
        noise = F.lit(self.log_k) + F.log(F.greatest("n_words", F.lit(1)).cast("double"))
        return F.aggregate(
            "scores", F.lit(0.0), lambda x, s: x + F.greatest(F.lit(self.rate) * s - noise, F.lit(0.0))
        )

    def probability(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(self.intercept) + F.lit(self.slope) * self.evidence())))


class _Words:
    """A block's words, as slots: of the word, and of its stem (-1 for words as short as one)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        folded = FOLD[data]
        self.starts, self.ends, self.first = word_spans(folded, offsets)
        opens = (data & 0xC0) != 0x80
        self.chars = np.concatenate([[0], np.cumsum(opens)])
        places = np.append(np.flatnonzero(opens), len(data))
        stem_ends = places[np.minimum(self.chars[self.starts] + STEM_CHARS, len(places) - 1)]
        longer = stem_ends < self.ends
        self.slots = self._slots(span_hashes(folded, self.starts, self.ends))
        self.stems = np.full(len(self.slots), -1)
        stems = span_hashes(folded, self.starts[longer], stem_ends[longer])
        self.stems[longer] = self._slots(mixed(stems ^ np.uint64(STEM_CHARS)))

    @staticmethod
    def _slots(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        own = weights[self.slots]
        return np.where(own != 0, own, weights[self.stems] * (self.stems >= 0)).astype(np.float64) - DRIFT


def _slot_counts(docs: DataFrame, kind: str) -> DataFrame:
    """``(slot, kind, n)`` of whole texts, ``kind`` a whole-number column of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for rows, data, offsets in text_blocks(batches, "text"):
            words = _Words(data, offsets)
            kinds = np.repeat(rows.column(kind).to_numpy(zero_copy_only=False), np.diff(words.first))
            for k in np.unique(kinds).tolist():
                own, stems = words.slots[kinds == k], words.stems[kinds == k]
                seen, n = np.unique(np.concatenate([own, stems[stems >= 0]]), return_counts=True)
                counts.setdefault(k, np.zeros(1 << SLOT_BITS, np.int64))[seen] += n
        for k, n in counts.items():
            seen = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen, pa.int32()), pa.array(np.full(len(seen), k), pa.int32()), pa.array(n[seen])],
                ["slot", "kind", "n"],
            )

    return docs.select("text", F.col(kind).cast("int").alias(kind)).mapInArrow(run, "slot int, kind int, n long")


def slot_weights(docs: DataFrame, labelled: DataFrame, scratch: Scratch) -> np.ndarray:
    """Each slot's weight: the log-odds of a word or stem between toxic and clean texts of
    ``labelled(text, toxic)``, with a Dirichlet prior that follows the words of all ``docs``,
    moved towards 0 by DEVIATIONS standard deviations."""
    everywhere = _slot_counts(docs.withColumn("kind", F.lit(2)), "kind")
    counts = everywhere.union(_slot_counts(labelled.withColumn("kind", F.col("toxic")), "kind"))
    n = [F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)) for k in range(3)]
    counts = counts.groupBy("slot").agg(n[0].alias("clean"), n[1].alias("toxic"), n[2].alias("all"))
    total = {c: F.sum(c) for c in ("clean", "toxic", "all")}
    counts, seen = scratch.save(counts, "words", total)
    weights = np.zeros(1 << SLOT_BITS, np.float32)
    if not seen.get("clean") or not seen.get("toxic"):
        return weights
    # A class's prior grows with its own words, so words that neither class has are even.
    usual = F.col("all") * (PRIOR_SHARE / seen["all"])
    toxic, clean = (F.col(c) + usual * seen[c] for c in ("toxic", "clean"))
    odds = F.log(toxic / seen["toxic"]) - F.log(clean / seen["clean"])
    sure = F.abs(odds) - DEVIATIONS * F.sqrt(1 / toxic + 1 / clean)
    weight = F.signum(odds) * F.floor(F.greatest(sure, F.lit(0.0)) * STEPS) / STEPS
    told = counts.select("slot", weight.alias("weight")).where("weight <> 0").toArrow()
    weights[told.column("slot").to_numpy()] = told.column("weight").to_numpy()
    return weights


def _rate(gains: list[tuple[float, int]], n_words: int) -> float:
    """The positive root of ``E[exp(rate * score)] = 1`` over the words of clean text, by
    halving. ``gains`` counts the scores above 0; others are taken for ``-DRIFT``. One more
    word of the highest score is put there, without which there need be no root."""
    if not gains:
        return 1.0
    scores, n = np.array([*gains, (max(gains)[0], 1)], float).T

    def excess(rate: float) -> float:
        rest = n_words + 1 - n.sum()
        return float(n @ np.exp(np.minimum(rate * scores, 700)) + rest * np.exp(-rate * DRIFT)) - n_words - 1

    low, high = 0.0, 1e-3
    while excess(high) < 0:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def segment_table(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``(doc_id, n_words, gains, starts, ends, scores)``: the word scores above 0 of each whole
    text and its maximal scoring segments, in code points, end exclusive."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_blocks(batches, "text"):
            words = _Words(data, offsets)
            scores, chars = words.scores(shared.value), words.chars
            sums = np.concatenate([[0.0], np.cumsum(scores)])
            positive = np.flatnonzero(scores > 0)
            cuts = np.searchsorted(positive, words.first)
            found: list[tuple[list, ...]] = []
            for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if a == b:
                    found.append(([], [], [], []))
                    continue
                places = positive[a:b]
                got = maximal_segments(places.tolist(), sums[places], sums[places + 1])
                at = chars[offsets[i]]
                found.append((
                    scores[places].tolist(),
                    [int(chars[words.starts[s]] - at) for s, _, _ in got],
                    [int(chars[words.ends[e - 1]] - at) for _, e, _ in got],
                    [score for _, _, score in got],
                ))
            kinds = (pa.float64(), pa.int64(), pa.int64(), pa.float64())
            lists = [pa.array([f[k] for f in found], pa.list_(kind)) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(np.diff(words.first)), *lists],
                ["doc_id", "n_words", "gains", "starts", "ends", "scores"],
            )

    schema = "doc_id long, n_words long, gains array<double>, starts array<long>, ends array<long>, scores array<double>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def _calibrated(rows: list, rounds: int = 50) -> tuple[float, float]:
    """Intercept and slope of a logistic curve through ``(bin, toxic, n)``."""
    x = np.array([(r.bin + 0.5) * BIN_WIDTH if r.bin else 0.0 for r in rows])
    toxic, n = (np.array([r[c] for r in rows], float) for c in ("toxic", "n"))
    design = np.stack([np.ones(len(x)), x], axis=1)
    ridge = np.diag([0.01, 0.01])
    fitted = np.array([np.log((toxic.sum() + 0.5) / (n.sum() - toxic.sum() + 0.5)), 0.0])

    def loss(v: np.ndarray) -> float:
        z = design @ v
        return float(n @ np.logaddexp(0, z) - toxic @ z + v @ ridge @ v / 2)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-design @ fitted))
        curvature = (design * (n * p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(curvature, design.T @ (n * p - toxic) + ridge @ fitted)
        while loss(fitted - step) > loss(fitted) and np.abs(step).max() > 1e-12:
            step = step / 2
        fitted = fitted - step
    return float(fitted[0]), max(0.0, float(fitted[1]))


def fit_toxicity(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> tuple[ToxicModel | None, DataFrame]:
    """The model and the stored segments of all documents; no model without both labels.

    Counts, the law of clean segments and the curve each cover every labelled row that is not
    held out; the prior covers all documents. The number of segments of a score ``s`` or
    more in ``n`` words of clean text is taken as ``K n exp(-rate s)``, so the best one of a
    text follows a Gumbel law.
    """
    known = labels.where("toxic is not null").select(F.col("doc_id").cast("long"), "toxic")
    known = known.where(F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known, _ = scratch.save(known, "known")
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    # Only texts that may have a label move to meet it, at every size in the same way.
    asked, _ = IdFilter(known, "doc_id", scratch).split(docs, "doc_id")
    labelled = asked.join(known.hint("shuffle_hash"), "doc_id").select("text", "toxic")
    weights = slot_weights(docs, labelled, scratch)
    found, _ = scratch.save(segment_table(docs, weights), "segments")
    told = found.where("n_words > 0").join(known, "doc_id")
    clean = told.where("toxic = 0")
    n_words = clean.agg(F.sum("n_words")).first()[0]
    if n_words is None or not told.where("toxic = 1").take(1):
        return None, found
    # Scores are multiples of 1/STEPS, so there are some ten thousand different ones at most.
    gains = clean.select(F.explode("gains").alias("gain")).groupBy("gain").count().collect()
    rate = _rate([tuple(r) for r in gains], n_words)
    each = clean.select(F.explode("scores").alias("score"))
    seen = each.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("score", TAIL, 10_000).alias("at")).first()
    at = seen["at"] or 0.0
    above = each.where(F.col("score") > at).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("score") - at).alias("excess")).first()
    # Above a high threshold excesses are exponential; the root stands in for one more of them.
    rate = (above["n"] + 1) / ((above["excess"] or 0.0) + 1 / rate)
    model = ToxicModel(weights, rate, float(np.log((above["n"] + 1) / n_words) + rate * at), 0.0, 0.0)
    place = F.when(F.col("evidence") > 0, F.least(F.floor(F.col("evidence") / BIN_WIDTH) + 1, F.lit(BINS))).otherwise(0)
    bins = told.withColumn("evidence", model.evidence()).groupBy(place.cast("int").alias("bin")).agg(
        F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n")
    )
    return ToxicModel(weights, rate, model.log_k, *_calibrated(bins.collect())), found


def toxicity_scores(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """``(doc_id, held_out, score, n_passages)``, one row per row of ``docs``.

    Learnt from labels whose doc_id is not held out (crc32 of the doc_id as text modulo 5
    is 0) alone; a score is read from the text only, so equal texts score the same. Null,
    empty and wordless texts have no passage and score like clean text. A document with
    several labels is toxic if one is 1; labels of no document and null doc_ids in either
    table teach nothing. Without a toxic or a clean text to learn from, every score is 0.
    An empty table gives an empty result; other columns are ignored. ``n_passages`` counts
    segments that a clean text of this length has less than once.
    """
    model, found = fit_toxicity(docs, labels, scratch)
    rows = found.withColumn("held_out", held_out())
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("n_passages"))
    few = F.size(F.filter("scores", lambda s: model.e_value(s, F.col("n_words")) < 1)).cast("long")
    return rows.select("doc_id", "held_out", model.probability().alias("score"), few.alias("n_passages"))


def toxic_passages(
    docs: DataFrame, labels: DataFrame, scratch: Scratch, most_expected: float = 1e-4
) -> DataFrame:
    """``(doc_id, start, end, score, e_value)`` of every passage that a clean text of the same
    length has less than ``most_expected`` times; code points, end exclusive. Odd rows as in
    ``toxicity_scores``: what has no words, or no model, has no passage."""
    model, found = fit_toxicity(docs, labels, scratch)
    each = found.select("doc_id", "n_words", F.explode(F.arrays_zip("starts", "ends", "scores")).alias("s"))
    each = each.select("doc_id", "n_words", F.col("s.starts").alias("start"), F.col("s.ends").alias("end"), F.col("s.scores").alias("score"))
    e_value = F.lit(1.0) if model is None else model.e_value(F.col("score"), F.col("n_words"))
    each = each.withColumn("e_value", e_value).drop("n_words")
    return each.where("false" if model is None else F.col("e_value") < most_expected)


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = toxicity_scores(docs, labels, Scratch(spark))
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return rows.select("doc_id", "held_out", "score", predicted, "n_passages")
