"""Split-parallel scan of tag-delimited blocks."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_records(spark: SparkSession, path, start_tag: str, end_tag: str) -> DataFrame:
    """``(block, record_file, record, at_file_start, closed)``: what can be a block.

    Records are cut at the start tag, so the text source splits large files over tasks
    (and bz2; a gz file is one task). A record without an end tag is not ``closed`` and has a null block. What
    stands before a file's first start tag is the file's first record and no block,
    whatever it holds; ``drop_file_heads`` finds it by its number. All records of a
    file's first split are kept for that.
    """
    if not start_tag or not end_tag:
        raise ValueError("both the start tag and the end tag of a block are needed")
    # Numbered directly above the scan: ascending within a split.
    records = spark.read.text(path, lineSep=start_tag).select(
        "value",
        F.col("_metadata.file_path").alias("record_file"),
        (F.col("_metadata.file_block_start") == 0).alias("at_file_start"),
        F.monotonically_increasing_id().alias("record"),
    )
    closed = F.col("value").contains(end_tag)
    content = F.split("value", re.escape(end_tag), 2)[0]
    block = F.concat(F.lit(start_tag), content, F.lit(end_tag))
    return records.where(closed | F.col("at_file_start")).select(
        F.when(closed, block).alias("block"), "record_file", "record", "at_file_start",
        closed.alias("closed"),
    )


def file_heads(records: DataFrame) -> DataFrame:
    """``(record)``: the first record of each file."""
    starts = records.where("at_file_start").groupBy("record_file")
    return starts.agg(F.min("record").alias("record")).select("record")


def drop_file_heads(records: DataFrame, heads: DataFrame) -> DataFrame:
    """``records`` without ``heads``; numbers are joined, so that a large file is not one key."""
    return records.join(heads, "record", "left_anti")


def read_blocks(spark: SparkSession, path, start_tag: str, end_tag: str) -> DataFrame:
    """``(block, file_path)`` for each ``start_tag … end_tag`` range, tags included.

    A block whose end tag is missing is seen and dropped. The files are scanned a second
    time for the numbers of their first records; ``dump_graph`` gets by with one scan.
    """
    records = read_records(spark, path, start_tag, end_tag)
    blocks = drop_file_heads(records, file_heads(records))
    return blocks.where("closed").select("block", F.col("record_file").alias("file_path"))
