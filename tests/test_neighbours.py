"""Gap-coded neighbour blocks: round trips, hubs, size and access by page."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from linktide.sinks import neighbours as n


@pytest.fixture
def edges():
    rng = random.Random(4)
    found = {(s, rng.randrange(100_000)) for s in range(0, 3000, 3) for _ in range(rng.randrange(40))}
    return found | {(7, k) for k in range(0, 5000)} | {(8, 99_999), (10, 0), (10, 9)}


def test_round_trip(spark, scratch, edges, tmp_path):
    path = str(tmp_path / "blocks")
    n.write_neighbours(spark.createDataFrame(sorted(edges), "src int, dst int").repartition(7), path, scratch)
    blocks = n.read_neighbours(spark, path)
    assert {tuple(r) for r in n.block_edges(blocks).collect()} == edges
    assert n.block_edges(blocks).count() == len(edges)
    assert blocks.agg(F.max(F.size("gaps"))).first()[0] < n.BLOCK
    assert blocks.where("page = 7").count() >= 5000 // n.BLOCK  # no row holds a hub
    some = blocks.where("page = 10")
    assert sorted(r.dst for r in n.block_edges(some).collect()) == [0, 9]
    assert "PushedFilters: [IsNotNull(page), EqualTo(page,10)]" in some._jdf.queryExecution().executedPlan().toString()


def test_blocks_take_little_space(spark, scratch, tmp_path):
    rng = random.Random(5)
    pairs = [(s, d) for s in range(2000) for d in sorted(rng.sample(range(60_000), 60))]
    edges = spark.createDataFrame(pairs, "src int, dst int")
    n.write_neighbours(edges, str(tmp_path / "blocks"), scratch)
    edges.write.parquet(str(tmp_path / "plain"))
    per_edge = n.stored_bytes(spark, str(tmp_path / "blocks")) / len(pairs)
    # Gaps of 1000 on average: 10 bits each, a bit more for the largest of 32.
    assert per_edge < 2.0 < 0.7 * n.stored_bytes(spark, str(tmp_path / "plain")) / len(pairs)


def test_no_edges(spark, scratch, tmp_path):
    n.write_neighbours(spark.createDataFrame([], "src int, dst int"), str(tmp_path / "blocks"), scratch)
    assert n.block_edges(n.read_neighbours(spark, str(tmp_path / "blocks"))).collect() == []
