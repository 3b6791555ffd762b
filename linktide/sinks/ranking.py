"""The totally ordered ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linktide.scratch import Scratch
from linktide.sinks.text import write_key_values


def _order(rank: Column) -> list[Column]:
    # With the id as second key, ties (all pages without inlinks) spread over ranges.
    return [rank.desc(), F.col("id").asc()]


def ranking(ranks: DataFrame) -> DataFrame:
    """``(id, rank)`` by falling rank, then id: a range-partitioned total sort."""
    return ranks.select("id", "rank").orderBy(*_order(F.col("rank")))


def numbered(ranked: DataFrame, scratch: Scratch) -> DataFrame:
    """Add the 1-based ``position`` to an ordered DataFrame.

    Rows are numbered within their partition while the order is stored; only one
    count per partition is summed up, never the rows in one place.
    """
    place = F.monotonically_increasing_id()
    placed, _ = scratch.save(ranked.withColumn("place", place), "placed")
    range_no = F.shiftright("place", 33)
    counts = placed.groupBy(range_no.alias("range_no")).agg(F.count(F.lit(1)).alias("n"))
    before = W.orderBy("range_no").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("range_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    offset = F.col("place") - F.shiftleft("range_no", 33)
    return (
        placed.withColumn("range_no", range_no)
        .join(F.broadcast(offsets), "range_no")
        .select((F.col("skip") + offset + 1).alias("position"), *ranked.columns)
    )


def write_ranking(ranks: DataFrame, path: str) -> None:
    """Lines ``id TAB rank`` whose part files, in name order, are the ranking."""
    ordered = ranking(ranks)
    write_key_values(ordered.select(F.col("id").alias("key"), F.col("rank").alias("value")), path)
