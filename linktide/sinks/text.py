"""Line formats: ``key TAB value`` and ``id TAB rank outlink …``.

An id that would break a line format fails the write instead of changing the graph.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_key_values(df: DataFrame, path: str) -> None:
    """``df`` has ``key`` and ``value``."""
    key = _checked(F.col("key").cast("string"), r"[\t\r\n]", "tab or line break in key: ")
    value = _checked(F.col("value").cast("string"), r"[\r\n]", "line break in value: ")
    df.select(F.concat_ws("\t", key, value).alias("value")).write.mode("overwrite").text(path)


def write_adjacency(lists: DataFrame, list_name: str, path: str) -> None:
    """One line per ``id`` and list part; an empty list leaves the value empty."""
    members = _checked_members(F.col(list_name))
    pairs = lists.select(
        _checked_id(F.col("id")).alias("key"), F.array_join(members, " ").alias("value")
    )
    write_key_values(pairs, path)


def write_ranked_pages(pages: DataFrame, path: str) -> None:
    """``pages`` has ``id``, ``rank`` (a null one fails) and ``outlinks`` (null means none)."""
    head = F.concat(_checked_id(F.col("id")), F.lit("\t"), F.col("rank").cast("string"))
    ranked = F.when(F.col("rank").isNull(), F.raise_error(F.concat(F.lit("no rank for "), "id")))
    line = F.concat_ws(" ", F.coalesce(ranked.cast("string"), head), _checked_members(F.col("outlinks")))
    pages.where(F.col("id").isNotNull()).select(line.alias("value")).write.mode("overwrite").text(
        path
    )


def count_line(counted: DataFrame) -> DataFrame:
    """``(value)``: the line ``N=<n>`` from a one-row ``(n)``."""
    return counted.select(F.concat(F.lit("N="), F.col("n").cast("string")).alias("value"))


def write_count(spark: SparkSession, n: int, path: str) -> None:
    count_line(spark.range(1).select(F.lit(n).alias("n"))).write.mode("overwrite").text(path)


def _checked(value: Column, forbidden: str, message: str) -> Column:
    return F.when(
        value.rlike(forbidden), F.raise_error(F.concat(F.lit(message), value))
    ).otherwise(value)


def _checked_id(value: Column) -> Column:
    return _checked(value, r"\s", "whitespace in id: ")


def _checked_members(members: Column) -> Column:
    # One search per list, not one per member.
    broken = F.array_join(members, "").rlike(r"\s")
    return F.when(
        broken, F.raise_error(F.lit("whitespace in a linked id")).cast("array<string>")
    ).otherwise(members)
