"""Hot keys: exact detection, and results that do not depend on it."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from linktide.operators import skew
from linktide.operators.graph import drop_red_links, inlink_lists, outlink_lists
from linktide.operators.node_filter import MOST_NODES, NodeFilter
from linktide.operators.rank import ranked_pages


@pytest.fixture
def links(spark):
    """A third of the rows on one target, a third on one red target."""
    rows = [(f"s{i}", "hot") for i in range(100)] + [(f"s{i}", "red") for i in range(100)]
    rows += [(f"s{i}", f"t{i % 50}") for i in range(100)]
    return spark.createDataFrame(rows, "src string, dst string")


def test_hot_keys_are_exact(links, scratch):
    hot = skew.hot_keys(links, "dst", 300, scratch, floor=99)
    assert [r.n_parts for r in hot.collect()] == [2, 2]
    named = skew._hashed(links.select("dst").distinct(), "dst").join(hot, list(skew._HASHES))
    assert {r.dst for r in named.collect()} == {"hot", "red"}
    assert skew.hot_keys(links, "dst", 300, scratch, floor=100) is None
    assert skew.hot_keys(links, "dst", 300, scratch, floor=300) is None


def test_long_keys_are_split_like_others(spark, scratch):
    rows = spark.range(50).select(F.lit("x" * 300).alias("key"), "id")
    rows = rows.union(spark.range(50, 100).select(F.lit("short"), "id"))
    parted = skew.with_parts(rows, "key", "id", 100, scratch, floor=10)
    parts = parted.groupBy("key").agg(F.count_distinct("part").alias("n")).collect()
    assert len(parts) == 2 and all(r.n > 3 for r in parts)
    ids = spark.createDataFrame([("x" * 300,)], "id string")
    kept = skew.semi_join(rows, "key", ids, 100, scratch, floor=10)
    assert kept.columns == rows.columns and kept.count() == 50


@pytest.mark.parametrize("total", [1, 10**6, 10**9, 10**12])
def test_number_of_hot_keys_is_bounded(total):
    assert total / skew.hot_threshold(total) <= skew.MAX_HOT_KEYS


@pytest.mark.parametrize("floor", [1, 20, 99, 1000])
def test_semi_join(spark, links, scratch, floor):
    wanted = {"hot", *(f"t{i}" for i in range(0, 50, 2))}
    ids = spark.createDataFrame([(w,) for w in wanted], "id string")
    kept = skew.semi_join(links, "dst", ids, 300, scratch, floor)
    assert kept.columns == links.columns
    expected = [tuple(r) for r in links.collect() if r.dst in wanted]
    assert sorted(map(tuple, kept.collect())) == sorted(expected)


@pytest.mark.parametrize("floor, shuffles", [(20, 3), (1000, 2)])
def test_duplicates_go_without_another_shuffle(spark, links, scratch, floor, shuffles):
    """One for each side of the join; hot rows have one of their own, after a combine."""
    copies, _ = scratch.save(links.union(links), "copies")
    ids = spark.createDataFrame([("hot",), ("t1",)], "id string")
    ids, _ = scratch.save(ids, "ids")
    kept = skew.semi_join(copies, "dst", ids, 600, scratch, floor, distinct=True)
    expected = {tuple(r) for r in links.collect() if r.dst in ("hot", "t1")}
    assert sorted(map(tuple, kept.collect())) == sorted(expected)
    plan = kept._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == shuffles


def test_parts_split_hot_keys_only(links, scratch):
    parted = skew.with_parts(links, "dst", "src", 300, scratch, floor=20)
    widest = parted.groupBy("dst", "part").count()
    assert parted.count() == 300
    assert {r.dst for r in parted.where("part > 0").collect()} == {"hot", "red"}
    assert widest.agg(F.max("count")).first()[0] < 60


@pytest.mark.parametrize("hot_rows", [3, 1000])
def test_clean_graph_with_hot_rows(graph_of, links, hot_rows):
    nodes = [f"s{i}" for i in range(0, 100, 2)] + ["hot", "t0", "t2"]
    pairs = [tuple(r) for r in links.collect()]
    graph = graph_of(nodes, pairs * 2, hot_rows=hot_rows)
    expected = {(s, d) for s, d in pairs if s in nodes and d in nodes}
    assert {tuple(r) for r in graph.edges.collect()} == expected
    assert graph.n_edges == len(expected)


@pytest.mark.parametrize("list_rows", [7, 1000])
def test_lists_of_a_hub_come_in_parts(graph_of, scratch, list_rows):
    members = [f"m{i}" for i in range(100)]
    links = [("hub", m) for m in members] + [(m, "hub") for m in members] + [("m1", "m2")]
    graph = graph_of(["hub", *members], links)
    for lists, name in (
        (outlink_lists(graph, scratch, list_rows), "outlinks"),
        (inlink_lists(graph, scratch, list_rows), "inlinks"),
    ):
        rows = [r for r in lists.collect() if r.id == "hub"]
        assert sorted(m for r in rows for m in r[name]) == sorted(members)
        assert all(r[name] == sorted(r[name]) for r in rows)
        assert len(rows) == 1 if list_rows == 1000 else len(rows) > 5
        assert len({r.part for r in rows}) == len(rows)


def test_node_filter_keeps_all_pages_and_few_red_links(spark, scratch):
    nodes = spark.range(5000).select(F.concat(F.lit("n"), "id").alias("id"))
    links = spark.range(40_000).select(F.concat(F.lit("n"), "id").alias("dst"), F.lit(1).alias("src"))
    for asked in (nodes, nodes.select(F.substring("id", 2, 9).cast("long").alias("id"))):
        ends = links if asked is nodes else links.select(F.substring("dst", 2, 9).cast("long").alias("dst"), "src")
        kept = NodeFilter(asked, 5000, scratch).keep(ends, "dst")
        assert kept.columns == ["dst", "src"]
        n = kept.count()
        assert kept.join(asked, F.col("dst") == F.col("id"), "left_semi").count() == 5000
        assert n < 5000 + 0.05 * 35_000
    assert NodeFilter(nodes, MOST_NODES + 1, scratch).keep(links, "dst") is links
    nothing = NodeFilter(nodes.limit(0), 0, scratch)
    assert nothing.keep(links, "dst") is links


def test_red_links_are_dropped_before_they_move(spark, graph_of, scratch):
    nodes = [f"n{i}" for i in range(50)]
    links = [(n, f"red{k}") for n in nodes for k in range(40)] + [(n, "n7") for n in nodes] + [("red1", n) for n in nodes]
    graph = graph_of(nodes, links)
    assert {(e.src, e.dst) for e in graph.edges.collect()} == {(n, "n7") for n in nodes}
    stored = spark.createDataFrame(links, "src string, dst string")
    known = NodeFilter(graph.nodes, 50, scratch)
    filtered = known.keep(known.keep(stored, "dst"), "src")
    assert filtered.count() < 50 + 0.1 * 2050
    plan = drop_red_links(filtered, graph.nodes, 2100, scratch)._jdf.queryExecution().executedPlan().toString()
    # Read from below: the filter's broadcast join stands under the exchange of the links.
    assert plan.index("ShuffledHashJoin") < plan.index("BroadcastHashJoin")
    assert plan.count("BroadcastHashJoin") == 2 and "LeftSemi" not in plan


def test_hubs_meet_their_parts_apart(spark, graph_of, scratch):
    nodes = [f"n{i}" for i in range(60)]
    graph = graph_of(nodes, [("n0", n) for n in nodes] + [("n1", n) for n in nodes[:30]] + [("n2", "n3")])
    ranks = graph.nodes.withColumn("rank", F.length("id").cast("double"))
    pages = ranked_pages(ranks, graph, scratch, list_rows=10)
    rows = pages.collect()
    assert sum(r.id == "n0" for r in rows) > 3 and all(r["rank"] == len(r.id) for r in rows)
    found = {n: sorted(x for r in rows if r.id == n for x in r.outlinks) for n in nodes}
    assert found == dict.fromkeys(nodes, []) | {"n0": sorted(nodes), "n1": sorted(nodes[:30]), "n2": ["n3"]}
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(id#\d+, \d", plan)  # no exchange on the id alone
