"""Registered queries, one per operator, over the trade tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linktide.journal import Journal
from linktide.operators import dictionary as d
from linktide.operators import graph as g
from linktide.operators import pages as p
from linktide.operators import rank as r
from linktide.plans.rank_dump import PAGE_END, PAGE_START, dump_graph, rank_dump
from linktide.scratch import Scratch, settings
from linktide.sinks import (
    count_line,
    numbered,
    ranking,
    write_adjacency,
    write_ranked_pages,
)
from linktide.sinks.neighbours import block_edges, read_neighbours, write_neighbours
from linktide.sinks.published import published
from linktide.sources import (
    malformed_ranked_pages,
    read_adjacency,
    read_blocks,
    read_key_values,
    read_ranked_pages,
    split_ranked_pages,
)
from linktide.testgraphs import trade_blocks, trade_graph, trade_links, trade_nodes, write_dump

# A task of ``block_scan_parts`` sorts the blocks of a few files of so many pages.
NODES_PER_FILE = 50_000

# The returned DataFrames read scratch tables, so the queries leave them in place.


def _dump_blocks(spark: SparkSession, sf_dir: str, compression: str | None = None) -> DataFrame:
    scratch = Scratch(spark)
    path = scratch.path("dump")
    write_dump(trade_blocks(spark, sf_dir, scratch), path, compression)
    return read_blocks(spark, path, PAGE_START, PAGE_END)


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.ranked_titles(p.parse_pages(trade_blocks(spark, sf_dir, Scratch(spark))))


def _ranking(spark: SparkSession, sf_dir: str, iterations: int):
    scratch = Scratch(spark)
    graph = trade_graph(spark, sf_dir, scratch, numbers=True)
    ranked = r.rank_graph(graph, scratch, iterations=iterations, snapshots=(iterations,))
    return scratch, graph, ranked


def _rounded(ranks: DataFrame) -> DataFrame:
    return ranks.select("id", F.round("rank", 6).alias("rank"))


def block_scan(spark, sf_dir):
    return _dump_blocks(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_blocks"))


def block_scan_gzip(spark, sf_dir):
    return _dump_blocks(spark, sf_dir, "gzip").agg(F.count(F.lit(1)).alias("n_blocks"))


def block_scan_bzip2(spark, sf_dir):
    return _dump_blocks(spark, sf_dir, "bzip2").agg(F.count(F.lit(1)).alias("n_blocks"))


def block_scan_parts(spark, sf_dir):
    """Blocks of files that start inside a page and end in another, with small splits."""
    scratch = Scratch(spark)
    path = _write_parts(spark, sf_dir, scratch)
    with settings(spark, {"spark.sql.files.maxPartitionBytes": 50_000}):
        found = read_blocks(spark, f"{path}/file=*", PAGE_START, PAGE_END)
        counted, _ = scratch.save(found.agg(F.count(F.lit(1)).alias("n_blocks")), "counted")
    return counted


def _write_parts(spark: SparkSession, sf_dir: str, scratch: Scratch) -> str:
    """The files of ``block_scan_parts``: four or more, so that none grows with the tables."""
    n_files = max(4, -(-trade_nodes(spark, sf_dir).count() // NODES_PER_FILE))
    blocks = trade_blocks(spark, sf_dir, scratch).select(F.lit(1).alias("place"), "block")
    tail = '<page id="0"><title>X</title></page> the end of a page</text></revision></page>'
    edges = [(0, tail), (2, "<page><title>cut off</title><text>[[S 1]]")]
    ends = spark.createDataFrame(edges, "place int, block string")
    files = F.explode(F.sequence(F.lit(0), F.lit(n_files - 1)))
    parted = blocks.withColumn("file", F.pmod(F.xxhash64("block"), F.lit(n_files)).cast("int")).union(
        ends.withColumn("file", files)
    )
    path = scratch.path("parts")
    dealt = parted.repartition(n_files, "file").sortWithinPartitions("file", "place")
    dealt.select("file", F.col("block").alias("value")).write.partitionBy("file").text(path)
    return path


def corrupt_pages(spark, sf_dir):
    """Pages with an entity, a CDATA section or a broken element, in turn by part."""
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("k"))
    kind = F.pmod("k", F.lit(3))
    text = (
        F.when(kind == 0, F.lit("a &amp; [[S 1]]"))
        .when(kind == 1, F.lit("<![CDATA[<b> [[S 2]] & [[S 3]]]]>"))
        .otherwise(F.lit("[[S 4]] <b>broken"))
    )
    block = F.concat(F.lit("<page><title>P "), "k", F.lit("</title><text>"), text, F.lit("</text></page>"))
    pages = p.parse_pages(parts.select(block.alias("block")))
    n_links = F.aggregate("texts", F.lit(0), lambda a, t: a + F.regexp_count(t, F.lit(r"\[\[")))
    return pages.select("title", "is_corrupt", n_links.cast("long").alias("n_links"))


def malformed_lines(spark, sf_dir):
    """Ranked-page lines of suppliers, every third without a rank."""
    scratch = Scratch(spark)
    path = scratch.path("lines")
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("k"))
    rank = F.when(F.pmod("k", F.lit(3)) == 0, "none").otherwise("1.5")
    suppliers.select(F.concat(F.lit("S"), "k", F.lit("\t"), rank, F.lit(" S1"))).write.text(path)
    return malformed_ranked_pages(spark, path)


def quarantined_lines(spark, sf_dir):
    """Ranked-page lines of suppliers with and without faults, split in one scan: the good
    ones, and the bad ones with their reason."""
    scratch = Scratch(spark)
    path = scratch.path("lines")
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("k"))
    kind = F.pmod("k", F.lit(4))
    rank = F.when(kind == 0, "\tnone S1").when(kind == 1, "").when(kind == 2, "\t").otherwise("\t1.5 S1 S2")
    suppliers.select(F.concat(F.lit("S"), "k", rank)).write.text(path)
    pages, bad, counts = split_ranked_pages(spark, path, scratch)
    good = pages.select("id", F.lit("page").alias("reason"), F.size("outlinks").cast("long").alias("n_out"))
    bad = bad.select(F.regexp_extract("line", r"^\S*", 0).alias("id"), "reason", F.lit(None).cast("long"))
    total = F.array(*[F.lit(counts[c]).cast("long") for c in ("pages", "no rank", "rank is no number")])
    return good.union(bad).withColumn("counts", F.array_join(total, " "))


def quarantined_pages(spark, sf_dir):
    """Blocks of a dump without a title or with broken markup, as a run puts them aside."""
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("k"))
    kind = F.pmod("k", F.lit(4))
    title = F.when(kind == 1, "").otherwise(F.concat(F.lit("P "), "k"))
    text = F.when(kind == 2, "[[P 3]] <b>broken").when(kind == 3, "[[P 4]]").otherwise("no link")
    head = F.when(kind == 0, "<page>").otherwise(F.concat(F.lit("<page><title>"), title, F.lit("</title>")))
    block = F.concat(head, F.lit("<text>"), text, F.lit("</text><id>"), "k", F.lit("</id></page>"))
    scratch = Scratch(spark)
    dump, out = scratch.path("dump"), scratch.path("results")
    write_dump(parts.select(block.alias("block")), dump)
    report = rank_dump(spark, dump, out, iterations=1, quarantine=True)
    bad = spark.read.parquet(f"{out}/quarantine")
    number = F.regexp_extract("excerpt", "<id>([0-9]+)</id>", 1).cast("long").alias("number")
    return bad.select(
        "reason", number, F.coalesce("id", F.lit("")).alias("id"),
        F.lit(report.n_untitled).cast("long").alias("n_untitled"), F.lit(report.n_corrupt).cast("long").alias("n_corrupt"),
    )


def parse_pages(spark, sf_dir):
    return _pages(spark, sf_dir).select("title", F.size("texts").alias("n_texts"))


def extract_links(spark, sf_dir):
    return p.extract_links(_pages(spark, sf_dir))


def filter_links(spark, sf_dir):
    return p.filter_links(p.extract_links(_pages(spark, sf_dir)))


def dump_edges(spark, sf_dir):
    graph, _ = dump_graph(_dump_blocks(spark, sf_dir), Scratch(spark))
    return graph.edges


def red_link_filter(spark, sf_dir):
    nodes, links = trade_nodes(spark, sf_dir), trade_links(spark, sf_dir)
    return g.clean_graph(nodes, links, Scratch(spark)).edges


def red_link_filter_hot(spark, sf_dir):
    """As ``red_link_filter``, with targets of more than 20 links taken as hot."""
    nodes, links = trade_nodes(spark, sf_dir), trade_links(spark, sf_dir)
    return g.clean_graph(nodes, links, Scratch(spark), hot_rows=20).edges


def ranking_hubs(spark, sf_dir):
    """As ``rank_round_8``, with pages of more than 20 outlinks taken as hubs."""
    scratch = Scratch(spark)
    graph = trade_graph(spark, sf_dir, scratch, numbers=True)
    graph = r.prepare_ranking(graph, scratch, hub_rows=20)
    return _rounded(r.rank_graph(graph, scratch).ranks(8))


def inlink_lists(spark, sf_dir):
    scratch = Scratch(spark)
    lists = g.inlink_lists(trade_graph(spark, sf_dir, scratch), scratch)
    return _listed(lists, "inlinks", "n_in")


def outlink_lists(spark, sf_dir):
    scratch = Scratch(spark)
    lists = g.outlink_lists(trade_graph(spark, sf_dir, scratch), scratch)
    return _listed(lists, "outlinks", "n_out")


def _listed(lists: DataFrame, name: str, size: str) -> DataFrame:
    return lists.select("id", F.col("degree").alias(size), F.array_join(name, " ").alias(name))


def _put_together(lists: DataFrame, name: str) -> DataFrame:
    whole = F.sort_array(F.flatten(F.collect_list(name)))
    return lists.groupBy("id", "degree").agg(whole.alias(name))


def inlink_lists_parts(spark, sf_dir):
    """As ``inlink_lists``, from parts of about 20 members."""
    scratch = Scratch(spark)
    lists = g.inlink_lists(trade_graph(spark, sf_dir, scratch), scratch, list_rows=20)
    return _listed(_put_together(lists, "inlinks"), "inlinks", "n_in")


def outlink_lists_parts(spark, sf_dir):
    """As ``outlink_lists``, from parts of about 20 members."""
    scratch = Scratch(spark)
    lists = g.outlink_lists(trade_graph(spark, sf_dir, scratch), scratch, list_rows=20)
    return _listed(_put_together(lists, "outlinks"), "outlinks", "n_out")


def page_count(spark, sf_dir):
    return g.page_count(trade_nodes(spark, sf_dir))


def count_property(spark, sf_dir):
    return count_line(g.page_count(trade_nodes(spark, sf_dir))).select(
        F.col("value").alias("line")
    )


def out_degrees(spark, sf_dir):
    return g.out_degrees(trade_graph(spark, sf_dir, Scratch(spark)).edges)


def rank_init(spark, sf_dir):
    scratch = Scratch(spark)
    graph = r.prepare_ranking(trade_graph(spark, sf_dir, scratch), scratch)
    named = graph.vertices.select("id", "name")
    return r.initial_state(graph).join(named, "id").select(
        F.col("name").alias("id"), "rank", F.col("out_degree").alias("n_out")
    )


def contributions(spark, sf_dir):
    scratch = Scratch(spark)
    graph = r.prepare_ranking(trade_graph(spark, sf_dir, scratch), scratch)
    received = r.contributions(r.initial_state(graph), graph)
    named = graph.vertices.select(F.col("id").alias("dst"), F.col("name").alias("id"))
    return received.join(named, "dst").select("id", F.round("contrib", 6).alias("contrib"))


def mass_by_round(spark, sf_dir):
    _, _, ranked = _ranking(spark, sf_dir, r.ROUNDS)
    return ranked.metrics(spark).select(
        "iteration",
        F.round("total_mass", 6).alias("total_mass"),
        F.round("sink_mass", 6).alias("sink_mass"),
    )


def rank_round_1(spark, sf_dir):
    return _rounded(_ranking(spark, sf_dir, 1)[2].ranks(1))


def rank_round_8(spark, sf_dir):
    return _rounded(_ranking(spark, sf_dir, 8)[2].ranks(8))


def ordered_ranking(spark, sf_dir):
    # Rounded before ordering, so that a last-bit difference cannot swap two ties.
    scratch, _, ranked = _ranking(spark, sf_dir, 8)
    return numbered(ranking(_rounded(ranked.ranks(8))), scratch)


def dense_ids(spark, sf_dir):
    scratch = Scratch(spark)
    nodes, counted = scratch.save(trade_nodes(spark, sf_dir), "nodes", {"n": F.count(F.lit(1))})
    return d.dense_ids(nodes, counted["n"], scratch)


def dense_edges(spark, sf_dir):
    """The edges in numbers, with targets and sources of more than 20 links taken as hot."""
    scratch = Scratch(spark)
    graph = trade_graph(spark, sf_dir, scratch)
    ids = d.dense_ids(graph.nodes, graph.n_nodes, scratch)
    return d.encode_edges(graph.edges, ids, graph.n_edges, scratch, hot_rows=20)


def _written_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    graph = trade_graph(spark, sf_dir, scratch)
    ids = d.dense_ids(graph.nodes, graph.n_nodes, scratch)
    path = scratch.path("neighbours")
    write_neighbours(d.encode_edges(graph.edges, ids, graph.n_edges, scratch), path, scratch)
    return read_neighbours(spark, path)


def neighbour_blocks(spark, sf_dir):
    """All edges, from the gap-coded blocks of their pages."""
    return block_edges(_written_neighbours(spark, sf_dir))


def neighbours_of_pages(spark, sf_dir):
    """The neighbours of the first and of some later pages, read by page."""
    blocks = _written_neighbours(spark, sf_dir)
    return block_edges(blocks.where("page < 10 or page between 200 and 230"))


def exact_ranking(spark, sf_dir):
    """As ``ranking``, by the last bit: nothing is rounded before ranks are compared."""
    scratch, _, ranked = _ranking(spark, sf_dir, 8)
    return numbered(ranking(ranked.ranks(8)), scratch)


def exact_masses(spark, sf_dir):
    _, _, ranked = _ranking(spark, sf_dir, r.ROUNDS)
    return ranked.metrics(spark)


def kv_text_roundtrip(spark, sf_dir):
    scratch = Scratch(spark)
    path = scratch.path("outlinks")
    lists = g.outlink_lists(trade_graph(spark, sf_dir, scratch), scratch)
    write_adjacency(lists, "outlinks", path)
    return read_key_values(spark, path)


def adjacency_text_links(spark, sf_dir):
    scratch = Scratch(spark)
    path = scratch.path("inlinks")
    lists = g.inlink_lists(trade_graph(spark, sf_dir, scratch), scratch)
    write_adjacency(lists, "inlinks", path)
    listed = read_adjacency(spark, path, "inlinks")
    return listed.select(F.explode("inlinks").alias("src"), F.col("id").alias("dst"))


def ranked_page_roundtrip(spark, sf_dir):
    scratch, graph, ranked = _ranking(spark, sf_dir, 1)
    path = scratch.path("ranked_pages")
    write_ranked_pages(r.ranked_pages(ranked.ranks(1), graph, scratch), path)
    return read_ranked_pages(spark, path).select(
        "id", F.round("rank", 6).alias("rank"), F.size("outlinks").cast("long").alias("n_out")
    )


def ranked_pages_parts(spark, sf_dir):
    """Ranked pages from lists in parts of about 20 members, put together again."""
    scratch, graph, ranked = _ranking(spark, sf_dir, 1)
    pages = r.ranked_pages(ranked.ranks(1), graph, scratch, list_rows=20)
    return pages.groupBy("id", "rank").agg(F.sum(F.size("outlinks")).alias("n_out"))


def dump_edges_parts(spark, sf_dir):
    """As ``dump_edges``, from pages written as blocks of about 20 links."""
    scratch = Scratch(spark)
    path = scratch.path("dump")
    write_dump(trade_blocks(spark, sf_dir, scratch, list_rows=20), path)
    graph, _ = dump_graph(read_blocks(spark, path, PAGE_START, PAGE_END), scratch)
    return graph.edges


def resumed_ranking(spark, sf_dir):
    """Three rounds, ranked pages to text and back, then the remaining five rounds."""
    scratch, graph, ranked = _ranking(spark, sf_dir, 3)
    path = scratch.path("ranked_pages")
    write_ranked_pages(r.ranked_pages(ranked.ranks(3), graph, scratch), path)
    pages = read_ranked_pages(spark, path)
    graph, start = r.pages_graph(pages, scratch)
    resumed = r.rank_graph(graph, scratch, iterations=5, snapshots=(5,), start=start)
    return _rounded(resumed.ranks(5))


def journal_resume(spark, sf_dir):
    """Three rounds with a journal, then all eight in another scratch folder: the second run
    finds the layout and the third round recorded, and computes five rounds."""
    folder = Scratch(spark).path("journal")
    with Scratch(spark) as scratch:
        graph = trade_graph(spark, sf_dir, scratch)
        for rounds in (3, 8):
            journal = Journal(spark, folder, {"damping": r.DAMPING})
            ranked = r.rank_graph(graph, journal.scratch(), iterations=rounds, snapshots=(rounds,), journal=journal)
    return ranked.ranks(8)


def initial_page_lines(spark, sf_dir):
    """Outlink lists from text, ranked with the initial rank."""
    scratch = Scratch(spark)
    path = scratch.path("outlinks")
    lists = g.outlink_lists(trade_graph(spark, sf_dir, scratch), scratch)
    write_adjacency(lists, "outlinks", path)
    pages = r.initial_pages(read_adjacency(spark, path))
    return pages.select("id", "rank", F.array_join("outlinks", " ").alias("outlinks"))


def _dump_results(spark: SparkSession, sf_dir: str) -> str:
    """The folder of a one-call run on the rendered dump."""
    scratch = Scratch(spark)
    dump, out = scratch.path("dump"), scratch.path("results")
    write_dump(trade_blocks(spark, sf_dir, scratch), dump)
    rank_dump(spark, dump, out)
    return out


def published_ranking(spark, sf_dir):
    """The ranking that a pointer leads to, after a run of one round and one of eight."""
    scratch = Scratch(spark)
    dump, out = scratch.path("dump"), scratch.path("results")
    write_dump(trade_blocks(spark, sf_dir, scratch), dump)
    for rounds in (1, 8):
        rank_dump(spark, dump, out, iterations=rounds, versioned=True, output_format="parquet")
    return spark.read.parquet(f"{published(spark, out)}/ranking_8")


def replaced_results(spark, sf_dir):
    """What is left of a first run's results after a second one replaced them: one round's
    ranking and no other, beside a table that is none of the results."""
    scratch = Scratch(spark)
    dump, out = scratch.path("dump"), scratch.path("results")
    write_dump(trade_blocks(spark, sf_dir, scratch), dump)
    rank_dump(spark, dump, out, iterations=2, output_format="parquet")
    trade_nodes(spark, sf_dir).write.parquet(f"{out}/notes")
    rank_dump(spark, dump, out, iterations=1, output_format="parquet", replace=True)
    rows = spark.read.option("recursiveFileLookup", "true").parquet(out).select(
        F.regexp_extract(F.col("_metadata.file_path"), r"/([a-z_0-9]+)/[^/]*$", 1).alias("result")
    )
    return rows.groupBy("result").agg(F.count(F.lit(1)).alias("n_rows"))


def rank_completeness(spark, sf_dir):
    """Pages, ranked pages, and pages of either kind that the other lacks."""
    _, graph, ranked = _ranking(spark, sf_dir, 2)
    ranks = ranked.ranks(2).select("id", F.lit(1).alias("ranked"))
    both = graph.nodes.withColumn("known", F.lit(1)).join(ranks, "id", "full")
    return both.agg(
        F.count("known").alias("n_pages"), F.count("ranked").alias("n_ranked"),
        F.count_if(F.col("known").isNull() | F.col("ranked").isNull()).alias("n_apart"),
    )


def _read_ranking(spark: SparkSession, path: str) -> DataFrame:
    value = F.col("value").cast("double").alias("rank")
    return _rounded(read_key_values(spark, path).select(F.col("key").alias("id"), value))


def dump_ranking(spark, sf_dir):
    """Dump in, ranking out: the one-call run, its result read back from text."""
    return _read_ranking(spark, f"{_dump_results(spark, sf_dir)}/ranking_8")


def dump_ranking_1(spark, sf_dir):
    return _read_ranking(spark, f"{_dump_results(spark, sf_dir)}/ranking_1")


def dump_outlinks(spark, sf_dir):
    return read_key_values(spark, f"{_dump_results(spark, sf_dir)}/outlinks")


def dump_totals(spark, sf_dir):
    """The page count and the masses of a one-call run, as read back."""
    out = _dump_results(spark, sf_dir)
    masses = read_key_values(spark, f"{out}/masses").select(
        F.col("key").cast("int").alias("iteration"),
        *[
            F.round(F.split("value", " ")[k].cast("double"), 6).alias(name)
            for k, name in enumerate(("total_mass", "sink_mass"))
        ],
    )
    return masses.withColumn("line", F.lit(spark.read.text(f"{out}/n").first().value))


QUERIES = {
    query.__name__: query
    for query in (
        block_scan,
        block_scan_gzip,
        block_scan_bzip2,
        block_scan_parts,
        corrupt_pages,
        malformed_lines,
        quarantined_lines,
        quarantined_pages,
        parse_pages,
        extract_links,
        filter_links,
        dump_edges,
        red_link_filter,
        red_link_filter_hot,
        ranking_hubs,
        inlink_lists,
        outlink_lists,
        inlink_lists_parts,
        outlink_lists_parts,
        page_count,
        count_property,
        out_degrees,
        rank_init,
        contributions,
        mass_by_round,
        rank_round_1,
        rank_round_8,
        dense_ids,
        dense_edges,
        neighbour_blocks,
        neighbours_of_pages,
        exact_ranking,
        exact_masses,
        kv_text_roundtrip,
        adjacency_text_links,
        ranked_page_roundtrip,
        ranked_pages_parts,
        dump_edges_parts,
        initial_page_lines,
        resumed_ranking,
        journal_resume,
        published_ranking,
        replaced_results,
        rank_completeness,
        dump_ranking,
        dump_ranking_1,
        dump_outlinks,
        dump_totals,
    )
} | {"ranking": ordered_ranking}
