"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linktide.scratch import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; the root is its least node.

    Alternates large-star and small-star: every node's larger neighbours move to the
    least one, then every node and its smaller neighbours do. Rows never outnumber the
    links, each round is a written table, and rounds end when the links stay as they
    are. Null ends and self-links link nothing.
    """
    edges = links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges, seen = _stored(edges.distinct(), scratch)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large, _ = _stored(large.distinct(), scratch)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(least.select("a", F.col("m").alias("b")))
        edges, now = _stored(small.distinct(), scratch)
        if now == seen:
            break
        seen = now
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def _stored(edges: DataFrame, scratch: Scratch):
    check = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return scratch.save(edges, "edges", {"n": F.count(F.lit(1)), "check": check})
