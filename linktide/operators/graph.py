"""Nodes, edges, adjacency lists and graph statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linktide.operators.dictionary import dense_ids
from linktide.operators.node_filter import NodeFilter
from linktide.operators.skew import HOT_ROWS, KeyParts, lookup, semi_join, with_parts
from linktide.scratch import Scratch, shuffle_partitions, string_partitions


@dataclass(frozen=True)
class Graph:
    """A clean graph in stored tables: distinct nodes, distinct edges between them."""

    nodes: DataFrame  # id
    edges: DataFrame  # src, dst
    n_nodes: int
    n_edges: int
    # With numbers: ``ids(id, number)``, the edges' table ``coded(src_number, dst, dst_number)``,
    # and ``links``, which joins ``src`` to it.
    ids: DataFrame | None = None
    links: DataFrame | None = None
    coded: DataFrame | None = None


def page_nodes(targets: DataFrame) -> DataFrame:
    """``(id)``: the distinct pages; blocks with the same title are one page."""
    return targets.select("id").distinct()


def page_links(targets: DataFrame) -> DataFrame:
    """``(src, dst)`` from per-page target lists."""
    return targets.select(F.col("id").alias("src"), F.explode("targets").alias("dst"))


def drop_red_links(
    links: DataFrame,
    nodes: DataFrame,
    n_links: int,
    scratch: Scratch,
    hot_rows: int = HOT_ROWS,
    counted_in: DataFrame | None = None,
) -> DataFrame:
    """The distinct links whose target is a node; ``counted_in`` as in ``semi_join``."""
    return semi_join(
        links, "dst", nodes, n_links, scratch, hot_rows, distinct=True, counted_in=counted_in
    )


def clean_graph(
    nodes: DataFrame,
    links: DataFrame,
    scratch: Scratch,
    *,
    max_links: int | None = None,
    sources_are_nodes: bool = False,
    hot_rows: int = HOT_ROWS,
    numbers: bool = False,
) -> Graph:
    """Distinct nodes and the distinct links between them.

    With ``numbers`` the nodes get their dense numbers first, and the joins that find red
    links bring those of both ends along, so that edges need not move for them again.
    ``links`` may be lists, ``(src, targets)`` of distinct targets: of lists, whole ones
    meet their source's number, and if every source has one list only, no link can be there
    twice. ``max_links`` is the number of ``links``, or a number above it, for links that
    are cheap to read again; without it they are stored and counted first. Links that
    pass a bit filter of the nodes move once, to the partition of their target's page, and
    duplicates are dropped there.
    """
    spark = scratch.spark
    counted = {"n": F.count(F.lit(1))}
    lists = links if "targets" in links.columns else None
    if lists is not None:
        lists = lists.select("src", "targets").where(F.size("targets") > 0)
        if max_links is None:
            lists, seen = scratch.save(lists, "lists", {"n": F.sum(F.size("targets"))})
            max_links = seen["n"] or 0
        links = _unfolded(lists)
    links = links.select("src", "dst")
    if max_links is None:
        links, seen = scratch.save(links, "links", counted)
        max_links = seen["n"]
    with shuffle_partitions(spark, string_partitions(spark, max_links)):
        nodes = nodes.where(F.col("id").isNotNull()).select("id").distinct()
        nodes, seen = scratch.save(nodes, "nodes", counted)
    n_nodes = seen["n"]
    known = NodeFilter(nodes, n_nodes, scratch)
    if numbers:
        with shuffle_partitions(spark, string_partitions(spark, max_links + n_nodes)):
            return _numbered_graph(
                nodes, links, lists, n_nodes, max_links, known, sources_are_nodes, scratch, hot_rows
            )
    # Hot ends are counted in the links as they are, not in the result of the filter and a join.
    all_links = links
    links = known.keep(links, "dst")
    if not sources_are_nodes:
        links = known.keep(links, "src")
    with shuffle_partitions(spark, string_partitions(spark, max_links + n_nodes)):
        if not sources_are_nodes:
            links = semi_join(
                links, "src", nodes, max_links, scratch, hot_rows, counted_in=all_links
            )
        links = drop_red_links(links, nodes, max_links, scratch, hot_rows, counted_in=all_links)
        edges, kept = scratch.save(links, "edges", counted)
    return Graph(nodes, edges, n_nodes, kept["n"])


def _unfolded(lists: DataFrame) -> DataFrame:
    others = [c for c in lists.columns if c != "targets"]
    return lists.select(*others, F.explode("targets").alias("dst"))


def _numbered_graph(
    nodes: DataFrame,
    links: DataFrame,
    lists: DataFrame | None,
    n_nodes: int,
    max_links: int,
    known: NodeFilter,
    sources_are_nodes: bool,
    scratch: Scratch,
    hot_rows: int,
) -> Graph:
    ids, _ = scratch.save(dense_ids(nodes, n_nodes, scratch), "ids")
    number = {end: ids.withColumnRenamed("number", f"{end}_number") for end in ("src", "dst")}
    all_links, repeated = links, True
    if lists is None:
        links = known.keep(links, "dst")
        if not sources_are_nodes:
            links = known.keep(links, "src")
        links = lookup(links, "src", number["src"], max_links, scratch, hot_rows, counted_in=all_links)
        links = links.select("src_number", "dst")
    else:
        seen = lists.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("src").alias("n_src")).first()
        repeated = seen["n"] != seen["n_src"]
        # No source has more lists than this; where that is too few for a hot one, none is counted.
        most = seen["n"] - seen["n_src"] + 1
        found = lookup(lists, "src", number["src"], seen["n"] if most > hot_rows else 0, scratch, hot_rows)
        links = known.keep(_unfolded(found.select("src_number", "targets")), "dst")
    # A source goes on as its number: neither the second move nor the search for duplicates
    # nor the stored edges have its id.
    links = lookup(
        links, "dst", number["dst"], max_links, scratch, hot_rows, distinct=repeated, counted_in=all_links
    )
    coded, kept = scratch.save(
        links.select("src_number", "dst", "dst_number"), "edges", {"n": F.count(F.lit(1))}
    )
    return coded_graph(nodes, ids, coded, n_nodes, kept["n"], scratch, hot_rows)


def coded_graph(
    nodes: DataFrame,
    ids: DataFrame,
    coded: DataFrame,
    n_nodes: int,
    n_edges: int,
    scratch: Scratch,
    hot_rows: int = HOT_ROWS,
) -> Graph:
    """The graph of stored numbers; sources get their ids where ``links`` or ``edges`` is read."""
    names = ids.select(F.col("number").alias("id"), F.col("id").alias("src"))
    links = lookup(coded, "src_number", names, n_edges, scratch, hot_rows)
    links = links.select("src", "dst", "src_number", "dst_number")
    return Graph(nodes, links.select("src", "dst"), n_nodes, n_edges, ids, links, coded)


def out_degrees(edges: DataFrame) -> DataFrame:
    """``(src, out_degree)`` for pages that have outlinks."""
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"))


def page_count(nodes: DataFrame) -> DataFrame:
    """One row ``(n)``; pages without links count."""
    return nodes.agg(F.count(F.lit(1)).alias("n"))


def inlink_lists(graph: Graph, scratch: Scratch, list_rows: int = HOT_ROWS) -> DataFrame:
    """``(id, part, degree, inlinks)`` for pages that are linked to.

    Lists are sorted and hold at most about ``list_rows`` members. A page with more has
    several rows, numbered by ``part``, so that no single row holds a hub's whole
    neighbourhood; ``degree`` is the page's full number of members in each of them.
    """
    edges = with_parts(graph.edges, "dst", "src", graph.n_edges, scratch, list_rows)
    members = edges.select(
        F.col("dst").alias("id"), "part", "key_rows", F.col("src").alias("member")
    )
    return _lists(members, "inlinks")


def outlink_lists(
    graph: Graph,
    scratch: Scratch,
    list_rows: int = HOT_ROWS,
    degrees: DataFrame | None = None,
    parts: KeyParts | None = None,
) -> DataFrame:
    """``(id, part, degree, outlinks)`` for every page, in parts as in ``inlink_lists``; a page
    without outlinks has an empty list. ``degrees`` is ``out_degrees`` where stored (of numbers,
    if the graph has them), ``parts`` is ``outlink_parts`` where known.
    """
    parts = parts or outlink_parts(graph, scratch, list_rows, degrees)
    if graph.coded is not None:
        return coded_lists(graph, parts).select("id", "part", "degree", "outlinks")
    edges = parts.of_rows(graph.edges, "src", "dst")
    members = edges.select(
        F.col("src").alias("id"), "part", "key_rows", F.col("dst").alias("member")
    )
    # Each page adds a null member, which a list leaves out: the outer join with the
    # pages happens in the same shuffle as the grouping.
    nothing = F.lit(None).cast("long")
    pages = graph.nodes.select("id", F.lit(0).cast("long"), nothing, F.lit(None))
    return _lists(members.union(pages), "outlinks")


def outlink_parts(
    graph: Graph, scratch: Scratch, list_rows: int = HOT_ROWS, degrees: DataFrame | None = None
) -> KeyParts:
    """How many parts the outlink lists of pages have; most have one. Of a graph with
    numbers, parts and ``degrees`` are by number."""
    edges, key = (graph.edges, "src") if graph.coded is None else (graph.coded, "src_number")
    counted = None
    if degrees is not None:
        counted = degrees.select(F.col("src").alias(key), F.col("out_degree").alias("n_rows"))
    return KeyParts(edges, key, graph.n_edges, scratch, list_rows, counted)


def coded_lists(graph: Graph, parts: KeyParts) -> DataFrame:
    """``(number, part, id, degree, outlinks)`` as in ``outlink_lists``, put together by number."""
    edges = parts.of_rows(graph.coded, "src_number", "dst")
    nothing = F.lit(None).cast(graph.ids.schema["id"].dataType)
    members = edges.select(
        F.col("src_number").alias("number"), "part", "key_rows", F.col("dst").alias("member"), nothing.alias("id")
    )
    # Each part of a page adds a null member with the page's id.
    pages = parts.per_part(graph.ids, "number").select(
        "number", "part", F.lit(None).cast("long"), nothing, "id"
    )
    lists = _lists(members.union(pages), "outlinks", "number", F.max("id").alias("id"))
    return lists.where("part = 0 or size(outlinks) > 0")


def _lists(members: DataFrame, list_name: str, key: str = "id", *others: Column) -> DataFrame:
    # Shuffling plain rows first beats partial lists: hardly any meet before the shuffle.
    together = members.repartition(key, "part")
    members = F.sort_array(F.collect_list("member"))
    degree = F.coalesce(F.max("key_rows"), F.count("member"))
    return together.groupBy(key, "part").agg(*others, degree.alias("degree"), members.alias(list_name))
