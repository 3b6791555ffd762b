"""Time the headline queries; print one JSON line.

BENCH_SF_DIR picks the tables (default sf0.1), BENCH_CPUS the local cores, BENCH_RUNS the
runs per query after one warm-up run; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from linktide import Scratch, rank_dump, rank_graph
from linktide.operators.graph import clean_graph, inlink_lists, outlink_lists
from linktide.operators.pages import extract_links, filter_links, parse_pages, ranked_titles
from linktide.operators.rank import ROUNDS, prepare_ranking
from linktide.plans.rank_dump import PAGE_END, PAGE_START, dump_graph
from linktide.sinks import ranking
from linktide.sources import read_blocks, read_records
from linktide.testgraphs import trade_blocks, trade_graph, trade_links, trade_nodes, write_dump

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HUB_ROWS = 100  # low enough that hot targets and hubs are on their own paths


def run_all(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def shuffle_bytes(log_folder: str, job_group: str) -> int:
    """Shuffle bytes written by the jobs of a group, from the event log."""
    stages, total = set(), 0
    for path in Path(log_folder).iterdir():
        for line in path.open(encoding="utf-8"):
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                if event.get("Properties", {}).get("spark.jobGroup.id") == job_group:
                    stages.update(event["Stage IDs"])
            elif event["Event"] == "SparkListenerTaskEnd" and event["Stage ID"] in stages:
                metrics = event.get("Task Metrics") or {}
                total += metrics.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
    return total


def main() -> None:
    log_folder = tempfile.mkdtemp(prefix="linktide-bench-log-")
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("linktide-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.eventLog.dir", f"file:{log_folder}")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    kept = Scratch(spark)
    graph = trade_graph(spark, SF_DIR, kept)
    laid_out = prepare_ranking(graph, kept)
    ranked = rank_graph(laid_out, kept)
    dump, results = kept.path("dump"), kept.path("results")
    write_dump(trade_blocks(spark, SF_DIR, kept), dump)
    blocks = read_blocks(spark, dump, PAGE_START, PAGE_END)
    records = read_records(spark, dump, PAGE_START, PAGE_END)
    n_blocks = blocks.count()

    def last_rounds(scratch):
        spark.sparkContext.setJobGroup("rounds", "rank rounds")
        rank_graph(laid_out, scratch)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    queries = {
        "block_scan": lambda scratch: blocks.count(),
        "filter_links": lambda scratch: run_all(
            filter_links(extract_links(ranked_titles(parse_pages(blocks))))
        ),
        "dump_to_graph": lambda scratch: dump_graph(records, scratch),
        "tables_to_graph": lambda scratch: trade_graph(spark, SF_DIR, scratch),
        "inlink_lists": lambda scratch: run_all(inlink_lists(graph, scratch)),
        "outlink_lists": lambda scratch: run_all(outlink_lists(graph, scratch)),
        "prepare_ranking": lambda scratch: prepare_ranking(graph, scratch),
        "rank_8_rounds": last_rounds,
        "hub_rounds": lambda scratch: rank_graph(
            prepare_ranking(graph, scratch, hub_rows=HUB_ROWS), scratch
        ),
        "red_links_hot": lambda scratch: clean_graph(
            trade_nodes(spark, SF_DIR), trade_links(spark, SF_DIR), scratch, hot_rows=HUB_ROWS
        ),
        "ranking": lambda scratch: run_all(ranking(ranked.ranks(ROUNDS))),
        "dump_to_ranking": lambda scratch: rank_dump(spark, dump, results, replace=True),
    }
    seconds = {}
    for name, query in queries.items():
        times = []
        for _ in range(1 + RUNS):
            with Scratch(spark) as scratch:
                started = time.perf_counter()
                query(scratch)
                times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
    kept.close()
    spark.stop()

    round_bytes = shuffle_bytes(log_folder, "rounds") // ((1 + RUNS) * ROUNDS)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(SF_DIR.rsplit("sf", 1)[-1]),
                "details": {
                    "nodes": graph.n_nodes,
                    "edges": graph.n_edges,
                    "seconds_per_round": round(seconds["rank_8_rounds"] / ROUNDS, 3),
                    "shuffle_bytes_per_round": round_bytes,
                    "ingest_pages_per_second": round(n_blocks / seconds["dump_to_graph"]),
                    "runs": RUNS,
                    "cpus": int(CPUS),
                },
            }
        )
    )


if __name__ == "__main__":
    main()
