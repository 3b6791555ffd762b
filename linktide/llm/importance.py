"""Target-distribution importance resampling over hashed n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linktide.llm.common import table, text_blocks
from linktide.llm.crc_grams import RunningCrcs, sql_crc32
from linktide.scratch import Scratch
from linktide.sinks.ranking import numbered

WORDS = 3
BUCKETS = 10_000
SEED = "42"
LEAST_WORDS = 20
PERCENT = 5


def bucket_counts(docs: DataFrame, words: int = WORDS, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)``: how many n-grams of 1 to ``words`` words of all whole texts fall in
    each bucket. A task sends one row per bucket, so what moves hangs on tasks, not on text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for _, data, offsets in text_blocks(batches, "text"):
            crcs = RunningCrcs(data, offsets)
            for size in range(1, words + 1):
                n += np.bincount(crcs.grams(size)[1] % np.uint32(buckets), minlength=buckets)
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n[seen])], ["bucket", "n"])

    counted = docs.select("text").mapInArrow(run, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Each bucket's ``floor(1000 ln(p / q))``, ``p`` and ``q`` its add-one shares of the
    target's and of the source's n-grams."""
    all_source, all_target = float(sum(source.values())), float(sum(target.values()))
    gains = []
    for b in range(buckets):
        s, t = float(source.get(b, 0)), float(target.get(b, 0))
        share = ((t + 1) * (all_source + buckets)) / ((s + 1) * (all_target + buckets))
        gains.append(floor(1000 * log(share)))
    return gains


def gumbel(seed: str, doc_id: int | None) -> int:
    """Gumbel noise in thousandths, fixed by seed and doc_id; a null doc_id is empty text."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(sha256(name.encode()).hexdigest()[:8], 16)
    return floor(-1000 * log(-log((h + 0.5) / 4294967296)))


def importance_scores(
    docs: DataFrame, target: DataFrame, *, words: int = WORDS, buckets: int = BUCKETS, seed: str = SEED
) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score)``, one row per row of ``docs``.

    Features are the runs of 1 to ``words`` words of the whole text, repeats counted, each
    in the bucket of its CRC-32. ``weight`` is the log importance of the text under the
    target's bucket shares against those of all ``docs``, in thousandths, ``score`` is
    ``weight`` with Gumbel noise. A null, empty or wordless text has no features and weight
    0. Rows that repeat a doc_id have the same noise; a null doc_id is hashed as empty
    text. Without rows or words on one side its shares are all equal. Other columns of
    either table are ignored. What the driver gets is ``buckets`` numbers a table.
    """
    counts = [{r.bucket: r.n for r in bucket_counts(t, words, buckets).collect()} for t in (docs, target)]
    gains = np.array(bucket_gains(*counts, buckets), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_blocks(batches, "text"):
            crcs = RunningCrcs(data, offsets)
            n_words = np.diff(crcs.first)
            gained = np.zeros(len(crcs.after) + 1, np.int64)
            for size in range(1, words + 1):
                k, crc = crcs.grams(size)
                gained[k + 1] += gains[crc % np.uint32(buckets)]
            sums = np.cumsum(gained)[crcs.first]
            weights = np.diff(sums)
            features = sum(np.maximum(n_words - size, 0) for size in range(words))
            noise = [gumbel(seed, i) for i in rows.column("doc_id").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(n_words), pa.array(features), pa.array(weights), pa.array(weights + noise)],
                ["doc_id", "n_words", "n_features", "weight", "score"],
            )

    schema = "doc_id long, n_words long, n_features long, weight long, score long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def importance_sample(
    docs: DataFrame, target: DataFrame, scratch: Scratch, *, percent: int = PERCENT,
    least_words: int = LEAST_WORDS, **options,
) -> DataFrame:
    """``importance_scores`` with ``rank``: 1, 2, 3… of the documents drawn, else null.

    Of the N documents of ``least_words`` words or more, the ``percent * N // 100`` highest
    scores are drawn, ties to the smaller doc_id (null first): the top of scores with
    Gumbel noise is a sample without replacement in proportion to importance. Rows that
    agree in both follow each other in any order. The narrow rows are sorted by ranges of
    score and doc_id, so ties spread.
    """
    scored = importance_scores(docs, target, **options)
    enough = F.col("n_words") >= least_words
    scored, seen = scratch.save(scored, "scores", {"n": F.count_if(enough)})
    drawn = percent * seen["n"] // 100
    ordered = scored.where(enough).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first(), "n_features")
    placed = numbered(ordered, scratch).withColumn("rank", F.when(F.col("position") <= drawn, F.col("position")))
    unplaced = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    columns = [*scored.columns, "rank"]
    return placed.select(columns).unionByName(unplaced.select(columns))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    rows = importance_sample(docs, target, Scratch(spark))
    return rows.select("doc_id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
OP13_SQL = f"""
with docs as (select row_number() over () as r, doc_id, {_WORDS} as w from documents),
texts as (select r, w from docs union all select -1, {_WORDS} from benchmark),
spelled as (
  select r, array_to_string(w[i:i + n - 1], ' ') as f
  from texts, (values (1), (2), (3)) as sizes(n), unnest(range(1, len(w) - n + 2)) as places(i)),
coded as (select f, {sql_crc32('f')} % 10000 as b from (select distinct f from spelled)),
counted as (select r, b, count(*) as n from spelled join coded using (f) group by r, b),
sides as (
  select b, coalesce(sum(n) filter (r > 0), 0)::double as s, coalesce(sum(n) filter (r < 0), 0)::double as t
  from (select * from counted union all select 1, range, 0 from range(10000)) group by b),
gains as (
  select b, cast(floor(1000 * ln(((t + 1) * (sum(s) over () + 10000)) / ((s + 1) * (sum(t) over () + 10000)))) as bigint) as g
  from sides),
weighed as (select r, sum(n) as n_features, sum(n * g) as weight from counted join gains using (b) group by r),
hashed as (
  select *, cast('0x' || substr(sha256('42:' || coalesce(cast(doc_id as varchar), '')), 1, 8) as bigint) as h
  from docs left join weighed using (r)),
scored as (
  select doc_id, len(w) >= 20 as enough, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double))))::bigint as score
  from hashed),
placed as (
  select *, row_number() over (partition by enough order by score desc, doc_id nulls first, n_features) as place,
    5 * count(*) filter (enough) over () // 100 as drawn
  from scored)
select doc_id, n_features, weight, score, case when enough and place <= drawn then place end as rank from placed
"""
