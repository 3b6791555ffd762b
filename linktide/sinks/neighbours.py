"""Neighbour lists over dense numbers as gap-coded blocks, with access by page.

A block holds up to ``BLOCK`` neighbours of one page in ascending order: the first one, and the
gaps to the next. Blocks are sorted by page over all files. Gaps are small, and are written
in as many bits as the largest of 32 needs; page numbers and first neighbours are written
as differences. A reader that asks for some pages skips files, row groups and pages of
the files by the least and the greatest number in them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linktide.scratch import Scratch

BLOCK = 128
# Bit-packed differences instead of dictionaries; file pages small enough to be skipped.
_LAYOUT = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "false",
    "parquet.page.row.count.limit": "2000",
    "compression": "zstd",
}


def neighbour_blocks(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(page, first, gaps)`` of distinct ``edges(src, dst)`` in numbers.

    Edges are sorted by ranges and numbered in their range; what has the same page and the
    same number of whole ``BLOCK`` rows before it is a block. So a hub's list, however long,
    lies over many blocks and ranges, and no group is larger than a block.
    """
    ordered = edges.select("src", "dst").orderBy("src", "dst")
    placed, _ = scratch.save(ordered.withColumn("place", F.monotonically_increasing_id()), "placed")
    members = F.sort_array(F.collect_list("dst"))
    blocks = placed.groupBy(F.col("src").alias("page"), F.floor(F.col("place") / BLOCK).alias("block")).agg(
        members.alias("dst")
    )
    size = F.size("dst")
    gaps = F.zip_with(F.slice("dst", F.lit(2), size), F.slice("dst", F.lit(1), size - 1), lambda b, a: b - a)
    return blocks.select("page", F.get("dst", F.lit(0)).alias("first"), gaps.alias("gaps"))


def write_neighbours(edges: DataFrame, path: str, scratch: Scratch) -> None:
    """Write the blocks of ``edges`` below ``path``."""
    blocks = neighbour_blocks(edges, scratch)
    ordered = blocks.repartitionByRange("page", "first").sortWithinPartitions("page", "first")
    ordered.write.options(**_LAYOUT).parquet(path)


def read_neighbours(spark: SparkSession, path: str) -> DataFrame:
    """``(page, first, gaps)``; filters on ``page`` reach the files."""
    return spark.read.parquet(path)


def block_edges(blocks: DataFrame) -> DataFrame:
    """``(src, dst)`` from blocks; a running sum over at most ``BLOCK`` gaps."""
    running = F.aggregate(
        "gaps", F.array("first"), lambda found, gap: F.concat(found, F.array(F.element_at(found, -1) + gap))
    )
    return blocks.select(F.col("page").alias("src"), F.explode(running).alias("dst"))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """The bytes of a stored folder."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(context._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
