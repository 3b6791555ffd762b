"""Numbers that come with the red-link joins, and hot keys found by slots."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from linktide.operators import dictionary, rank, skew
from linktide.operators.graph import clean_graph
from linktide.plans import queries
from linktide.scratch import Scratch

NODES = ["d", "b", "a", "c", "a"]
LINKS = [("a", "b"), ("a", "b"), ("b", "c"), ("c", "x"), ("x", "a"), (None, "a"), ("d", "a"), ("c", "a"), ("a", None)]
CLEAN = [("a", "b"), ("b", "c"), ("c", "a"), ("d", "a")]


def _numbered(graph):
    ids = {row.id: row.number for row in graph.ids.collect()}
    assert ids == {n: k for k, n in enumerate(sorted(set(NODES)))}
    found = sorted(tuple(row) for row in graph.links.select("src", "dst", "src_number", "dst_number").collect())
    assert found == [(s, t, ids[s], ids[t]) for s, t in CLEAN]
    assert sorted(map(tuple, graph.edges.collect())) == CLEAN
    assert (graph.n_nodes, graph.n_edges) == (4, 4)


@pytest.mark.parametrize("hot_rows", [1, 200_000])
def test_links_bring_numbers(graph_of, hot_rows):
    _numbered(graph_of(NODES, LINKS, hot_rows=hot_rows, numbers=True))


@pytest.mark.parametrize("hot_rows", [1, 200_000])
@pytest.mark.parametrize("parts", [1, 2])
def test_lists_bring_numbers(spark, scratch, hot_rows, parts):
    """Lists of their own per source, and sources with several lists that share targets."""
    lists = {}
    for src, dst in LINKS:
        lists.setdefault(src, []).append(dst)
    rows = [(s, sorted({t for t in ts if t}) + [None] * (None in ts)) for s, ts in lists.items() if s != "x"] * parts
    nodes = spark.createDataFrame([(n,) for n in NODES], "id string")
    targets = spark.createDataFrame([*rows, ("d", [])], "src string, targets array<string>")
    _numbered(clean_graph(nodes, targets, scratch, sources_are_nodes=True, hot_rows=hot_rows, numbers=True))


def test_numbered_edges_do_not_move_again(graph_of, scratch, monkeypatch):
    graph = graph_of(NODES, LINKS, numbers=True)
    plain = rank.rank_graph(graph_of(NODES, LINKS), scratch)
    monkeypatch.delattr(rank, "encode_edges")
    ranked = rank.rank_graph(graph, scratch)
    assert sorted(ranked.ranks(8).collect()) == sorted(plain.ranks(8).collect())
    assert ranked.metric_rows == plain.metric_rows
    hubs = rank.rank_graph(rank.prepare_ranking(graph, scratch, hub_rows=1), scratch)
    assert sorted(hubs.ranks(8).collect()) == sorted(plain.ranks(8).collect())


def _stored(monkeypatch):
    names, save = [], Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, df, name, *a: names.append(name) or save(self, df, name, *a))
    return names


def test_keys_are_not_counted_where_no_slot_is_full(spark, scratch, monkeypatch):
    rows = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    names = _stored(monkeypatch)
    assert skew.hot_keys(rows, "k", 3000, scratch, 1000) is None
    assert names == ["slots_k"]


def test_hot_keys_of_full_slots(spark, scratch):
    keys = F.when(F.col("id") < 1500, "hot").when(F.col("id") < 2600, None).otherwise(F.col("id").cast("string"))
    hot = skew.hot_keys(spark.range(3000).select(keys.alias("k")), "k", 3000, scratch, 1000).collect()
    assert sorted((row.n_rows, row.n_parts) for row in hot) == [(1100, 2), (1500, 2)]


def test_targets_are_counted_before_the_first_lookup(spark, scratch, monkeypatch):
    """No hot end: neither count reads more than the stored edges."""
    edges, _ = scratch.save(spark.createDataFrame([(f"n{k}", f"n{k + 1}") for k in range(50)], "src string, dst string"), "e")
    nodes = spark.createDataFrame([(f"n{k}",) for k in range(51)], "id string")
    ids = dictionary.dense_ids(nodes, 51, scratch)
    plans, found = [], skew.hot_keys
    monkeypatch.setattr(skew, "hot_keys", lambda df, *a: plans.append(df) or found(df, *a))
    encoded = dictionary.encode_edges(edges, ids, 50, scratch)
    assert [df is edges for df in plans] == [True, True]
    assert encoded.count() == 50


def test_files_of_parts_grow_in_number(spark, scratch, monkeypatch):
    monkeypatch.setattr(queries, "NODES_PER_FILE", 20)
    path = queries._write_parts(spark, "/root/testdata/sf0.001", scratch)
    files = spark.read.text(path).select("file").distinct().count()
    assert files == -(-349 // 20)
    counted = queries.block_scan_parts(spark, "/root/testdata/sf0.001").first().n_blocks
    monkeypatch.setattr(queries, "NODES_PER_FILE", 1_000_000)
    assert counted == queries.block_scan_parts(spark, "/root/testdata/sf0.001").first().n_blocks
