"""How edges lie in their buckets, and how many there are."""

from __future__ import annotations

from pyspark.sql import functions as F

from linktide.operators import rank


def test_edges_lie_by_target_in_their_buckets(spark, graph_of, scratch):
    nodes = [f"n{k:02d}" for k in range(40)]
    links = [(nodes[k], nodes[k * j % 40]) for k in range(40) for j in range(2, 12)]
    laid_out = rank.prepare_ranking(graph_of(nodes, links, numbers=True), scratch)
    files = {}
    rows = laid_out.edges.select(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("k"), "dst")
    for row in sorted(rows.collect(), key=lambda r: r.k):
        files.setdefault(row.f, []).append(row.dst)
    assert sum(map(len, files.values())) == len(set(links))
    assert all(found == sorted(found) for found in files.values())


def test_large_graphs_have_as_many_buckets_for_each_core(spark):
    for rows in (64_000_001, 100_000_000, 127_000_000):
        assert rank.bucket_count(spark, rows) == 16
    assert rank.bucket_count(spark, 64_000_000) == 8
