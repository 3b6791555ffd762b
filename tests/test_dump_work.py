"""What a run on a dump does once instead of once per link, and that results stay as they are."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from linktide import testgraphs
from linktide.functions import normalise_title
from linktide.operators import skew
from linktide.operators.graph import clean_graph
from linktide.plans import rank_dump as plan
from linktide.scratch import sorted_lists
from linktide.sinks import write_adjacency

LISTS_SETTING = "spark.sql.execution.useObjectHashAggregateExec"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_titles_need_no_table_of_characters(spark):
    rows = spark.createDataFrame([(" a  é\t_ ",), ("",), (None,)], "t string")
    found = rows.select(normalise_title(F.col("t")).alias("t"))
    assert "translate" not in _plan(found)
    assert [r.t for r in found.collect()] == ["_a__é\t__", "", None]


@pytest.mark.parametrize("broken", ["a b", " a", "a\n", "\t", "a\u000bb"])
def test_one_broken_member_fails_the_list(spark, tmp_path, broken):
    lists = spark.createDataFrame([("x", ["ok", broken])], "id string, outlinks array<string>")
    with pytest.raises(Exception, match="whitespace in a linked id"):
        write_adjacency(lists, "outlinks", str(tmp_path / "broken"))


def test_members_are_searched_once_per_list(spark, tmp_path, monkeypatch):
    rows = [("x", ["a", "b", None]), ("y", []), ("z", None), ("w", ["", "c"])]
    lists = spark.createDataFrame(rows, "id string, outlinks array<string>")
    plans, write = [], write_adjacency.__globals__["write_key_values"]
    monkeypatch.setitem(
        write_adjacency.__globals__, "write_key_values", lambda df, path: plans.append(_plan(df)) or write(df, path)
    )
    write_adjacency(lists, "outlinks", str(tmp_path / "lists"))
    assert "exists(" not in plans[0]
    lines = {r.value for r in spark.read.text(str(tmp_path / "lists")).collect()}
    assert lines == {"x\ta b", "y\t", "z", "w\t c"}


@pytest.mark.parametrize(("copies", "counted"), [(1, False), (3, True)])
def test_sources_of_one_list_each_are_not_counted(spark, scratch, monkeypatch, copies, counted):
    keys, found = [], skew._full_slots
    monkeypatch.setattr(skew, "_full_slots", lambda df, key, *a: keys.append(key) or found(df, key, *a))
    nodes = [f"n{k}" for k in range(9)]
    rows = [(n, [m for m in nodes if m != n]) for n in nodes] + [("n0", ["n1", "red"])] * (copies - 1)
    lists, _ = scratch.save(spark.createDataFrame(rows, "src string, targets array<string>"), "lists")
    pages = spark.createDataFrame([(n,) for n in nodes], "id string")
    graph = clean_graph(
        pages, lists, scratch, max_links=100, sources_are_nodes=True, hot_rows=2, numbers=True
    )
    assert ("src" in keys) == counted and "dst" in keys
    assert sorted(map(tuple, graph.edges.collect())) == sorted((n, m) for n in nodes for m in nodes if m != n)


def test_results_of_a_dump_are_written_from_sorted_lists(spark, scratch, monkeypatch):
    """Neither the dump's blocks nor the outlink lists are put together in a hash table."""
    schema = "c_custkey long, c_acctbal double"
    ids = [(k,) for k in range(1, 4)]
    tables = {
        "customer": spark.createDataFrame([(k, 1.0) for (k,) in ids], schema),
        "supplier": spark.createDataFrame(ids, "s_suppkey long"),
        "part": spark.createDataFrame(ids, "p_partkey long"),
        "orders": spark.createDataFrame([(k, k) for (k,) in ids], "o_orderkey long, o_custkey long"),
        "lineitem": spark.createDataFrame(
            [(k, s, 1, f) for (k,) in ids for (s,) in ids for f in "ARN"],
            "l_orderkey long, l_suppkey long, l_partkey long, l_returnflag string",
        ),
    }
    folder = scratch.path("tables")
    for name, table in tables.items():
        table.write.parquet(f"{folder}/{name}.parquet")
    blocks = testgraphs.trade_blocks(spark, folder, scratch)
    with sorted_lists(spark):
        again = testgraphs.trade_blocks(spark, folder, scratch)
        assert "ObjectHashAggregate" not in _plan(again)
        found = sorted(r.block for r in again.collect())
    assert found == sorted(r.block for r in blocks.collect())
    dump, out = scratch.path("dump"), scratch.path("results")
    testgraphs.write_dump(blocks, dump)
    seen, write = [], plan.write_adjacency
    monkeypatch.setattr(
        plan, "write_adjacency", lambda lists, *a: seen.append(_plan(lists)) or write(lists, *a)
    )
    before = spark.conf.get(LISTS_SETTING)
    plan.rank_dump(spark, dump, out, iterations=1)
    assert len(seen) == 1 and "ObjectHashAggregate" not in seen[0] and "SortAggregate" in seen[0]
    assert spark.conf.get(LISTS_SETTING) == before
    lines = dict(r.value.split("\t") for r in spark.read.text(f"{out}/outlinks").collect())
    assert lines["C_1"] == "P_1 S_1 S_2 S_3" and lines["S_2"] == "C_1 C_2 C_3" and lines["P_1"] == ""
