"""What the shared steps of the graph queries move and count, and that results stay as they are."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from linktide import testgraphs
from linktide.operators import graph as g
from linktide.operators import rank, skew
from linktide.scratch import Scratch

NODES = [f"n{k}" for k in range(30)]
LINKS = [("n0", n) for n in NODES] + [(n, "n1") for n in NODES] + [("n2", "red"), ("red", "n2"), (None, "n3"), ("n3", None)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _counted(monkeypatch):
    plans, found = [], skew.hot_keys
    monkeypatch.setattr(skew, "hot_keys", lambda df, *a: plans.append(df) or found(df, *a))
    return plans


@pytest.mark.parametrize("hot_rows", [1, 200_000])
def test_hot_ends_of_red_links_are_counted_in_the_links_as_they_are(spark, scratch, monkeypatch, hot_rows):
    links, _ = scratch.save(spark.createDataFrame(LINKS, "src string, dst string"), "given")
    nodes = spark.createDataFrame([(n,) for n in NODES], "id string")
    plans = _counted(monkeypatch)
    graph = g.clean_graph(nodes, links, scratch, max_links=len(LINKS), hot_rows=hot_rows)
    assert len(plans) == 2 and not any("Join" in _plan(df) for df in plans)
    kept = {(s, t) for s, t in LINKS if s in NODES and t in NODES}
    assert sorted(map(tuple, graph.edges.collect())) == sorted(kept)


@pytest.mark.parametrize("list_rows", [5, 200_000])
def test_lists_of_a_numbered_graph(graph_of, scratch, list_rows):
    """The same lists as of a graph without numbers, and no stored or moved source id."""
    plain, coded = graph_of(NODES, LINKS), graph_of(NODES, LINKS, numbers=True)
    assert coded.coded.columns == ["src_number", "dst", "dst_number"]

    def whole(lists):
        return {
            n: (sorted(t for r in rows for t in r.outlinks), {r.degree for r in rows})
            for n, rows in ((n, [r for r in found if r.id == n]) for found in [lists.collect()] for n in NODES)
        }

    lists = g.outlink_lists(coded, scratch, list_rows)
    assert lists.columns == ["id", "part", "degree", "outlinks"]
    assert whole(lists) == whole(g.outlink_lists(plain, scratch, list_rows))
    assert not re.search(r"hashpartitioning\((src|id)#", _plan(lists))
    ranks = coded.nodes.withColumn("rank", F.length("id").cast("double"))
    pages = rank.ranked_pages(ranks, coded, scratch, list_rows).collect()
    assert all(r["rank"] == len(r.id) for r in pages) and {r.id for r in pages} == set(NODES)
    found = {n: sorted(t for r in pages if r.id == n for t in r.outlinks) for n in NODES}
    assert found == {n: targets for n, (targets, _) in whole(lists).items()}


def test_given_pages_are_stored_once(spark, scratch, monkeypatch):
    names, save = [], Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, df, name, *a: names.append(name) or save(self, df, name, *a))
    rows = [("a", 1.0, ["b", "b", "x"]), ("b", 2.0, []), ("c", 3.0, None)]
    graph, start = rank.pages_graph(spark.createDataFrame(rows, "id string, rank double, outlinks array<string>"), scratch)
    assert "given" in names and "lists" not in names
    assert [tuple(r) for r in graph.edges.collect()] == [("a", "b")]
    assert sorted(map(tuple, start.collect())) == [("a", 1.0), ("b", 2.0), ("c", 3.0)]


def test_contributions_count_a_share_once_per_page(graph_of, scratch):
    graph = rank.prepare_ranking(graph_of(NODES, LINKS), scratch)
    received = rank.contributions(rank.initial_state(graph), graph)
    plan = received._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("FLOOR")  # from above: below the join with the edges
    names = dict(graph.vertices.select("id", "name").collect())
    found = {names[r.dst]: r.contrib for r in received.collect()}
    degrees = {n: len({t for s, t in LINKS if s == n and t in NODES}) for n in NODES}
    for n in NODES:
        assert found[n] == pytest.approx(sum(1 / degrees[s] for s in {s for s, t in LINKS if t == n and s in NODES}))


@pytest.mark.parametrize("list_rows", [3, 200_000])
def test_blocks_move_and_sort_targets_only(spark, scratch, monkeypatch, list_rows):
    """Sources that are no page, null ends and pages without links; a link is written behind the sort."""
    links = [("C1", "P2"), ("C1", "P10"), ("C1", "P2"), ("C1", "S4"), ("C1", None), ("C9", "P2"), (None, "P2"), ("S3", None)]
    monkeypatch.setattr(testgraphs, "trade_nodes", lambda *a: spark.createDataFrame([("C1",), ("S3",), ("P2",)], "id string"))
    monkeypatch.setattr(testgraphs, "trade_links", lambda *a: spark.createDataFrame(links, "src string, dst string"))
    blocks = testgraphs.trade_blocks(spark, "", scratch, list_rows)
    assert "|label" not in _plan(blocks).split("Exchange", 1)[1]
    if list_rows > 3:
        assert len(re.findall(r"Exchange hashpartitioning\(src#\d+, ", _plan(blocks))) == 1
    found = [r.block for r in blocks.collect()]
    titles = [re.search("<title>(.*)</title>", b)[1] for b in found]
    assert set(titles) == {"C 1", "C 1/talk", "S 3", "P 2"}
    texts = [re.search("<text>(.*)</text>", b)[1].split(" [[File")[0] for b, t in zip(found, titles, strict=True) if t == "C 1"]
    written = ["[[P 10|label]]", "[[P 2|label]]", "[[P 2|label]]", "[[S 4|label]]"]
    if list_rows > 3:
        assert texts == [" ".join(written)] and len(found) == 4
    else:
        assert sorted(x for t in texts for x in re.findall(r"\[\[[PS] \d+\|label\]\]", t)) == written
    assert all("[[S 1#h]]" in b for b, t in zip(found, titles, strict=True) if not t.endswith("/talk"))

