"""Line formats: ``key TAB value`` and ``id TAB rank outlink …``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linktide.scratch import Scratch

NO_RANK, BAD_RANK = "no rank", "rank is no number"


def read_key_values(spark: SparkSession, path) -> DataFrame:
    """``(key, value)``, cut at the first tab; no tab leaves the value empty."""
    pair = F.split("value", "\t", 2)
    return spark.read.text(path).select(
        F.get(pair, F.lit(0)).alias("key"),
        F.coalesce(F.get(pair, F.lit(1)), F.lit("")).alias("value"),
    )


def read_adjacency(spark: SparkSession, path, list_name: str = "outlinks") -> DataFrame:
    """``(id, <list_name>)`` from key/value lines whose value is a list of ids."""
    return read_key_values(spark, path).select(
        F.col("key").alias("id"), _words(F.col("value")).alias(list_name)
    )


def read_ranked_pages(spark: SparkSession, path, strict: bool = True) -> DataFrame:
    """``(id, rank, outlinks)``. A malformed line fails the read, or, when not
    ``strict``, is left to ``malformed_ranked_pages``."""
    lines = spark.read.text(path)
    tokens = F.split("value", r"\s")
    rank = F.expr("try_cast(get(split(value, '\\\\s'), 1) as double)")
    if strict:
        rank = F.when(_well_formed(), rank).otherwise(
            F.raise_error(F.concat(F.lit("not a ranked page: "), F.col("value")))
        )
    else:
        lines = lines.where(_well_formed())
    return lines.select(
        F.get(tokens, F.lit(0)).alias("id"),
        rank.alias("rank"),
        F.filter(F.slice(tokens, 3, F.size(tokens)), lambda t: t != "").alias("outlinks"),
    )


def split_ranked_pages(
    spark: SparkSession, path, scratch: Scratch
) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """``(pages, quarantine, counts)`` of ranked-page lines, which are read once.

    ``quarantine(reason, file, block_start, line)`` has the lines that are no ranked page,
    with the file, the start of the split that they are in, and why: ``no rank`` or ``rank is
    no number``. ``counts`` has the number of pages and of each reason.
    """
    tokens = F.split("value", r"\s")
    rank = F.expr("try_cast(get(split(value, '\\\\s'), 1) as double)")
    given = F.coalesce(F.get(tokens, F.lit(1)), F.lit("")) != ""
    reason = F.when(~given, NO_RANK).when(rank.isNull(), BAD_RANK)
    bad = reason.isNotNull()
    read = spark.read.text(path).select(
        F.when(~bad, F.get(tokens, F.lit(0))).alias("id"),
        rank.alias("rank"),
        F.when(~bad, F.filter(F.slice(tokens, 3, F.size(tokens)), lambda t: t != "")).alias("outlinks"),
        reason.alias("reason"),
        F.when(bad, F.col("_metadata.file_path")).alias("file"),
        F.when(bad, F.col("_metadata.file_block_start")).alias("block_start"),
        F.when(bad, F.col("value")).alias("line"),
    )
    asked = {"pages": None, NO_RANK: NO_RANK, BAD_RANK: BAD_RANK}
    metrics = {f"n_{k}": F.count_if(F.col("reason").eqNullSafe(F.lit(why))) for k, why in enumerate(asked.values())}
    stored, seen = scratch.save(read, "lines", metrics)
    counts = {name: seen.get(f"n_{k}") or 0 for k, name in enumerate(asked)}
    pages = stored.where("reason is null").select("id", "rank", "outlinks")
    return pages, stored.where("reason is not null").select("reason", "file", "block_start", "line"), counts


def malformed_ranked_pages(spark: SparkSession, path) -> DataFrame:
    """The lines (``value``) that hold no id and rank."""
    return spark.read.text(path).where(~_well_formed())


def _well_formed() -> Column:
    return F.expr("try_cast(get(split(value, '\\\\s'), 1) as double)").isNotNull()


def _words(value: Column) -> Column:
    return F.filter(F.split(value, r"\s"), lambda word: word != "")
