"""One call from a wiki dump to ranked pages."""

from __future__ import annotations

import logging
import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linktide.functions import is_subpage
from linktide.journal import Journal
from linktide.operators.graph import Graph, clean_graph, coded_graph, outlink_lists, page_nodes
from linktide.operators.pages import has_title, page_targets, parse_pages
from linktide.operators.rank import DAMPING, ROUNDS, Ranking, checked_snapshots, rank_graph
from linktide.scratch import Scratch, shuffle_partitions, sorted_lists, string_partitions
from linktide.sinks import (
    ranking,
    write_adjacency,
    write_count,
    write_key_values,
    write_ranking,
)
from linktide.sinks.published import drop_version, new_version, publish
from linktide.sources import drop_file_heads, file_heads, read_records

log = logging.getLogger(__name__)

# The tags around a page of a wiki dump.
PAGE_START = "<page>"
PAGE_END = "</page>"

# Files up to which the numbers of their first records (8 bytes each) are broadcast.
BROADCAST_FILES = 1_000_000

_MARKER = "_SUCCESS"
_RESULT = re.compile(rf"outlinks|n|masses|quarantine|ranking_\d+|{_MARKER}")


@dataclass(frozen=True)
class DumpReport:
    n_blocks: int
    n_corrupt: int
    n_untitled: int
    n_pages: int
    n_links: int
    masses: list[tuple[int, float, float]]


def dump_graph(blocks: DataFrame, scratch: Scratch) -> tuple[Graph, dict]:
    """The clean link graph of page blocks or of ``read_records``, and counts of the blocks."""
    return ingest(blocks, scratch)[:2]


def ingest(blocks: DataFrame, scratch: Scratch) -> tuple[Graph, dict, DataFrame]:
    """The clean link graph, counts of the blocks, and the quarantine: ``(reason, file, id,
    excerpt)`` of blocks without a title, which are lost, and of those with broken markup,
    which stay as pages without links. Plain blocks have no ``file``.

    Each block is parsed once: titles and targets are stored narrow, and nodes and
    links are both read from there. A link's source is a page by construction. Of
    records, each file's first one is found in what is stored, and left out.
    """
    pages, written = scratch.save(
        page_targets(parse_pages(blocks, excerpts=True), keep=True),
        "pages",
        {"n_links": F.coalesce(F.sum(F.size("targets")), F.lit(0))},
    )
    if "record" in pages.columns:
        heads, found = scratch.save(file_heads(pages), "heads", {"n": F.count(F.lit(1))})
        if found["n"] <= BROADCAST_FILES:
            heads = F.broadcast(heads)
        pages = drop_file_heads(pages, heads).where("closed")
    titled = has_title("id")
    counts = pages.agg(
        F.count(F.lit(1)).alias("n_blocks"),
        F.count_if("is_corrupt").alias("n_corrupt"),
        F.count_if(~titled).alias("n_untitled"),
    ).first()
    targets = pages.where(titled & ~is_subpage(F.col("id"))).select("id", "targets")
    graph = clean_graph(
        page_nodes(targets),
        targets.withColumnRenamed("id", "src"),
        scratch,
        max_links=written["n_links"],
        sources_are_nodes=True,
        numbers=True,
    )
    file = F.col("record_file") if "record_file" in pages.columns else F.lit(None).cast("string")
    bad = pages.where("reason is not null").select("reason", file.alias("file"), "id", "excerpt")
    return graph, counts.asDict(), bad


def rank_dump(
    spark: SparkSession,
    input_path,
    output_path: str,
    *,
    iterations: int = ROUNDS,
    damping: float = DAMPING,
    snapshots: Iterable[int] | None = None,
    output_format: str = "text",
    replace: bool = False,
    versioned: bool = False,
    resume: bool = False,
    quarantine: bool = False,
) -> DumpReport:
    """Rank the pages of a dump and write the results below ``output_path``.

    Writes ``outlinks``, ``n``, ``masses`` and one ``ranking_<round>`` per snapshot (the
    first and the last round unless given), then an empty file ``_SUCCESS``: results
    without it are of a run that failed. Results that are there already are refused, or
    removed first with ``replace``; nothing else below ``output_path`` is touched.
    ``output_format`` is ``text`` (ids must be free of whitespace) or ``parquet``.

    ``versioned`` results go to a new folder below ``versions`` and are published by a
    pointer once they are whole (``linktide.sinks.published`` finds them): earlier results
    stay readable until then, and for good if the run fails. With ``resume`` the graph, the
    layout and the rounds are recorded below ``_journal`` until the results are written; a run
    on the same files and damping that finds the journal of one whose driver died goes on
    after its last whole round. ``quarantine`` also writes what could not be read in full,
    with the reason, as the parquet table ``quarantine``; the report has their numbers.
    """
    if output_format not in ("text", "parquet"):
        raise ValueError(f"output_format {output_format!r} is neither text nor parquet")
    if iterations < 1:
        raise ValueError(f"iterations is {iterations}, at least 1 is needed")
    if not 0 <= damping <= 1:
        raise ValueError(f"damping is {damping}, not between 0 and 1")
    snapshots = checked_snapshots({1, iterations} if snapshots is None else snapshots, iterations)
    out = output_path.rstrip("/")
    if not versioned:
        _clear_results(spark, out, replace, unfinished=resume)
    journal = None
    if resume:
        journal = Journal(spark, f"{out}/_journal", {"input": _files(spark, input_path), "damping": damping})
    with journal.scratch() if journal else Scratch(spark) as scratch:
        graph, counts, bad = _journaled_graph(spark, input_path, scratch, journal)
        log.info("total pages: %d", graph.n_nodes)
        ranked = rank_graph(
            graph, scratch, iterations=iterations, damping=damping, snapshots=snapshots, journal=journal
        )
        write = _write_text if output_format == "text" else _write_parquet
        folder = new_version(out) if versioned else out
        try:
            partitions = string_partitions(spark, graph.n_nodes + graph.n_edges)
            with shuffle_partitions(spark, partitions), sorted_lists(spark):
                write(spark, graph, ranked, scratch, folder)
            if quarantine:
                bad.write.mode("overwrite").parquet(f"{folder}/quarantine")
            system, path = _file_system(spark, f"{folder}/{_MARKER}")
            system.create(path).close()
        except BaseException:
            if versioned:
                drop_version(spark, folder)
            raise
        if versioned:
            publish(spark, out, folder)
    if journal:
        journal.remove()
    return DumpReport(**counts, n_pages=graph.n_nodes, n_links=graph.n_edges, masses=ranked.metric_rows)


def _journaled_graph(
    spark: SparkSession, input_path, scratch: Scratch, journal: Journal | None
) -> tuple[Graph, dict, DataFrame]:
    """``ingest`` of a dump's records, or what a journal has of it."""
    facts = journal.read("graph") if journal else None
    if facts is not None:
        tables = {k: scratch.reopen(facts[k]) for k in ("nodes", "ids", "coded")}
        graph = coded_graph(**tables, n_nodes=facts["n_nodes"], n_edges=facts["n_edges"], scratch=scratch)
        return graph, facts["counts"], scratch.reopen(facts["bad"])
    graph, counts, bad = ingest(read_records(spark, input_path, PAGE_START, PAGE_END), scratch)
    if journal:
        bad, _ = scratch.save(bad, "bad")
        tables = {k: scratch.facts(getattr(graph, k)) for k in ("nodes", "ids", "coded")} | {"bad": scratch.facts(bad)}
        journal.write("graph", {**tables, "n_nodes": graph.n_nodes, "n_edges": graph.n_edges, "counts": counts})
    return graph, counts, bad


def _files(spark: SparkSession, input_path) -> list[list]:
    """What the input is made of: paths with bytes and, of files, the time of change."""
    found = []
    for pattern in [input_path] if isinstance(input_path, str) else list(input_path):
        system, path = _file_system(spark, pattern)
        for status in system.globStatus(path) or []:
            size = system.getContentSummary(status.getPath()).getLength()
            changed = 0 if status.isDirectory() else status.getModificationTime()
            found.append([str(status.getPath()), size, changed])
    return sorted(found)


def _file_system(spark: SparkSession, path: str):
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(context._jsc.hadoopConfiguration()), path


def _clear_results(spark: SparkSession, out: str, replace: bool, unfinished: bool = False) -> None:
    """Results of another run must not stand beside those of this one. ``unfinished``
    results, without the marker of a whole run, are replaced."""
    system, path = _file_system(spark, out)
    if not system.exists(path):
        return
    entries = {status.getPath().getName(): status.getPath() for status in system.listStatus(path)}
    found = sorted(name for name in entries if _RESULT.fullmatch(name))
    if found and not (replace or unfinished and _MARKER not in entries):
        raise FileExistsError(f"{out} holds results: {', '.join(found)}")
    for name in found:
        system.delete(entries[name], True)


def _outlinks(graph: Graph, ranked: Ranking, scratch: Scratch) -> DataFrame:
    degrees = ranked.graph.vertices.select(F.col("id").alias("src"), "out_degree")
    return outlink_lists(graph, scratch, degrees=degrees)


def _write_text(spark, graph: Graph, ranked: Ranking, scratch, out: str):
    write_adjacency(_outlinks(graph, ranked, scratch), "outlinks", f"{out}/outlinks")
    write_count(spark, graph.n_nodes, f"{out}/n")
    masses = ranked.metrics(spark).coalesce(1).selectExpr(
        "iteration as key", "concat_ws(' ', string(total_mass), string(sink_mass)) as value"
    )
    write_key_values(masses, f"{out}/masses")
    for number in sorted(ranked.states):
        write_ranking(ranked.ranks(number), f"{out}/ranking_{number}")


def _write_parquet(spark, graph: Graph, ranked: Ranking, scratch, out: str):
    tables = {
        "outlinks": _outlinks(graph, ranked, scratch),
        "n": spark.range(1).select(F.lit(graph.n_nodes).alias("n")),
        "masses": ranked.metrics(spark),
        **{f"ranking_{k}": ranking(ranked.ranks(k)) for k in sorted(ranked.states)},
    }
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{out}/{name}")
