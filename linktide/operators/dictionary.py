"""A distributed dictionary: every node gets a dense whole number.

Nodes are sorted by ranges, numbered within their range, and each range adds what stands
before it; only one count per range is summed up in one place. Numbers follow the order of
the ids, so they are the same whatever the partitioning. They can't collide, and they are
small: neighbours in edges, buckets and shuffles differ in few bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linktide.operators.skew import HOT_ROWS, lookup
from linktide.scratch import Scratch
from linktide.sinks.ranking import numbered

# Nodes up to which a number takes 4 bytes on storage.
INT_NODES = (1 << 31) - 1


def dense_ids(nodes: DataFrame, n_nodes: int, scratch: Scratch) -> DataFrame:
    """``(id, number)`` of distinct ``nodes(id)``: 0 to ``n_nodes - 1`` in the order of ids."""
    placed = numbered(nodes.select("id").orderBy("id"), scratch)
    kind = "int" if n_nodes <= INT_NODES else "long"
    return placed.select("id", (F.col("position") - 1).cast(kind).alias("number"))


def encode_edges(
    edges: DataFrame, ids: DataFrame, n_edges: int, scratch: Scratch, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``edges(src, dst)`` in numbers; an edge with an end that is no node drops out."""
    # Hot targets are counted in the edges as they are, not in the result of the first lookup.
    stored = edges
    for end in ("src", "dst"):
        found = lookup(edges, end, ids, n_edges, scratch, hot_rows, counted_in=stored)
        edges = found.drop(end).withColumnRenamed("number", end)
    return edges.select("src", "dst")
