"""Damped rank propagation over a fixed number of rounds.

Physical design, per round: the state (id, rank, out_degree) and the edges are
bucketed alike, so a page meets its outlinks without an exchange; shares are summed
per target before the only shuffle; the sums meet the state in its buckets again.
Pages with very many outlinks are kept apart: their edges lie spread over files and
meet a broadcast of the few hub shares. Both masses are observed while the round is
written, so they cost no pass of their own.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable
from dataclasses import dataclass, field, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linktide.journal import Journal
from linktide.operators.dictionary import dense_ids, encode_edges
from linktide.operators.graph import Graph, clean_graph, coded_lists, out_degrees, outlink_lists, outlink_parts
from linktide.operators.skew import HOT_ROWS, hot_keys, hot_threshold
from linktide.scratch import Scratch, shuffle_partitions, string_partitions

log = logging.getLogger(__name__)

# The rounds of a run, the damping, the rank of a page before the first round.
ROUNDS = 8
DAMPING = 0.85
INITIAL_RANK = 1.0

# Ranks are added up as whole numbers, so that a sum does not hang on the order in which
# its rows arrive: a count of 2 ** -20 and, of what is left, a count of 2 ** -52. Sums of
# either stay whole for 2 ** 31 rows of one target and 2 ** 43 pages; beyond, they fail.
COARSE, FINE = float(1 << 20), float(1 << 32)

# Sizes: a bucket of 8 million edges is about 130 MB of keys.
ROWS_PER_BUCKET = 8_000_000
SMALLEST_BUCKET = 20_000


@dataclass(frozen=True)
class RankGraph:
    """A graph laid out for ranking."""

    vertices: DataFrame  # id, name, out_degree; bucketed by id
    edges: DataFrame  # src, dst; bucketed by src; without the hubs' edges
    hub_edges: DataFrame | None  # src, dst of pages above hub_degree, spread evenly
    hub_degree: int
    n_nodes: int
    n_sinks: int
    buckets: int


@dataclass(frozen=True)
class Ranking:
    graph: RankGraph
    states: dict[int, DataFrame] = field(default_factory=dict)
    metric_rows: list[tuple[int, float, float]] = field(default_factory=list)

    def ranks(self, round_number: int) -> DataFrame:
        """``(id, rank)`` after a round kept as a snapshot."""
        state = self.states[round_number].select(F.col("id").alias("key"), "rank")
        names = self.graph.vertices.select(F.col("id").alias("key"), "name")
        return names.join(state.hint("shuffle_hash"), "key").select(
            F.col("name").alias("id"), "rank"
        )

    def metrics(self, spark: SparkSession) -> DataFrame:
        """``(iteration, total_mass, sink_mass)``: the masses entering each round."""
        schema = "iteration int, total_mass double, sink_mass double"
        return spark.createDataFrame(self.metric_rows, schema)


def bucket_count(spark: SparkSession, rows: int) -> int:
    """Buckets grow with the data; small graphs get no more than there are cores. Large ones get
    as many for each core, so that none waits for a last bucket of the others in every round."""
    cores = spark.sparkContext.defaultParallelism
    if rows > cores * ROWS_PER_BUCKET:
        return cores * -(-rows // (cores * ROWS_PER_BUCKET))
    return max(1, min(cores, -(-rows // SMALLEST_BUCKET)))


def prepare_ranking(graph: Graph, scratch: Scratch, *, hub_rows: int = HOT_ROWS) -> RankGraph:
    """Lay the graph out in buckets, under the dense numbers of its nodes."""
    spark = scratch.spark
    buckets = bucket_count(spark, graph.n_nodes + graph.n_edges)
    hub_degree = hot_threshold(graph.n_edges, hub_rows)
    if graph.coded is not None:
        ids = graph.ids
        edges = graph.coded.select(F.col("src_number").alias("src"), F.col("dst_number").alias("dst"))
    else:
        with shuffle_partitions(spark, string_partitions(spark, graph.n_nodes + graph.n_edges)):
            ids = dense_ids(graph.nodes, graph.n_nodes, scratch)
            encoded = encode_edges(graph.edges, ids, graph.n_edges, scratch, hub_rows)
            edges, _ = scratch.save(encoded, "encoded")
    with shuffle_partitions(spark, buckets):
        bucketed = None
        if hot_keys(edges, "src", graph.n_edges, scratch, hub_rows) is None:
            # Without hubs, degrees are counted in the buckets, where no edge moves for it.
            bucketed = edges = _bucketed_edges(edges, buckets, scratch)
        named = ids.select(F.col("number").alias("id"), F.col("id").alias("name"))
        degrees = out_degrees(edges).withColumnRenamed("src", "id")
        vertices, seen = scratch.save_bucketed(
            named.repartition(buckets, "id")
            .join(degrees.hint("shuffle_hash"), "id", "left")
            .select("id", "name", F.coalesce("out_degree", F.lit(0)).alias("out_degree")),
            "vertices",
            "id",
            buckets,
            {
                "sinks": F.count_if(F.col("out_degree") == 0),
                "widest": F.max("out_degree"),
            },
        )
        hub_edges = None
        if (seen.get("widest") or 0) > hub_degree:
            hubs = F.broadcast(
                vertices.where(F.col("out_degree") > hub_degree).select(F.col("id").alias("src"))
            )
            hub_edges, _ = scratch.save(edges.join(hubs, "src", "left_semi"), "hub_edges")
            edges = edges.join(hubs, "src", "left_anti")
        if bucketed is None:
            bucketed = _bucketed_edges(edges, buckets, scratch)
    return RankGraph(
        vertices, bucketed, hub_edges, hub_degree, graph.n_nodes, seen.get("sinks") or 0, buckets
    )


def _bucketed_edges(edges: DataFrame, buckets: int, scratch: Scratch) -> DataFrame:
    # Sorted once, by target: in every round a target's shares follow each other, so that summing
    # them up jumps about less in memory than their join does, and sums are shuffled in order.
    edges = edges.select("src", "dst").repartition(buckets, "src").sortWithinPartitions("dst")
    return scratch.save_bucketed(edges, "edges", "src", buckets)[0]


def initial_state(graph: RankGraph) -> DataFrame:
    """``(id, rank, out_degree)`` before the first round."""
    return graph.vertices.select("id", F.lit(INITIAL_RANK).alias("rank"), "out_degree")


def initial_pages(lists: DataFrame) -> DataFrame:
    """``(id, rank, outlinks)`` before the first round, from outlink lists."""
    return lists.select("id", F.lit(INITIAL_RANK).alias("rank"), "outlinks")


def ranked_pages(
    ranks: DataFrame, graph: Graph, scratch: Scratch, list_rows: int = HOT_ROWS
) -> DataFrame:
    """``(id, rank, outlinks)``: ranks with the page structure, one row per list part.

    A hub's rank is copied to the parts of its list, and they are joined by id and part, in
    the partitions that the lists are put together in.
    """
    parts = outlink_parts(graph, scratch, list_rows)
    if graph.coded is not None:
        ranks = parts.per_part(ranks.join(graph.ids, "id"), "number").select("number", "part", "rank")
        # Ranks are the hash table, so that no list moves or is sorted for the join.
        pages = ranks.hint("shuffle_hash").join(coded_lists(graph, parts), ["number", "part"])
        return pages.select("id", "rank", "outlinks")
    lists = outlink_lists(graph, scratch, list_rows, parts=parts)
    ranks = parts.per_part(ranks, "id")
    return ranks.join(lists, ["id", "part"]).select("id", "rank", "outlinks")


def pages_graph(pages: DataFrame, scratch: Scratch) -> tuple[Graph, DataFrame]:
    """The graph and the ranks ``(id, rank)`` held by ranked pages, to go on from them."""
    n_links = F.coalesce(F.sum(F.greatest(F.size("targets"), F.lit(0))), F.lit(0))
    stored, seen = scratch.save(
        pages.select("id", "rank", F.array_distinct("outlinks").alias("targets")), "given", {"n": n_links}
    )
    lists = stored.select(F.col("id").alias("src"), "targets")
    graph = clean_graph(
        stored, lists, scratch, max_links=seen["n"], sources_are_nodes=True, numbers=True
    )
    return graph, stored.select("id", "rank").distinct()


def _stored_start(graph: RankGraph, start: DataFrame, scratch: Scratch) -> tuple[DataFrame, dict]:
    """The state with given ranks, laid out like any round; every page needs a rank."""
    given = start.select(F.col("id").alias("name"), "rank")
    missing = F.raise_error(F.concat(F.lit("no rank given for "), F.col("name").cast("string")))
    state = graph.vertices.join(given, "name", "left").select(
        "id", F.coalesce("rank", missing.cast("double")).alias("rank"), "out_degree"
    )
    return scratch.save_bucketed(
        state.repartition(graph.buckets, "id"), "start", "id", graph.buckets, masses()
    )


def exact_sum(value: Column) -> Column:
    """The sum of numbers from 0 up, the same for every order and partitioning."""
    return _sum_of_counts(*_counts(value))


def _counts(value: Column) -> tuple[Column, Column]:
    """The whole numbers that ``exact_sum`` adds up."""
    coarse = F.floor(value * COARSE)
    return coarse, F.floor((value * COARSE - coarse) * FINE)


def _sum_of_counts(coarse: Column, fine: Column) -> Column:
    return F.sum(coarse) / F.lit(COARSE) + F.sum(fine) / F.lit(COARSE * FINE)


def contributions(state: DataFrame, graph: RankGraph) -> DataFrame:
    """``(dst, contrib)``: the sum of ``rank / out_degree`` over the inlinks."""
    # A share is counted once per page, not once per link.
    coarse, fine = _counts(F.col("rank") / F.col("out_degree"))
    shares = state.where("out_degree > 0").select(
        F.col("id").alias("src"), coarse.alias("coarse"), fine.alias("fine"), "out_degree"
    )
    counts = ["dst", "coarse", "fine"]
    received = shares.hint("shuffle_hash").join(graph.edges, "src").select(counts)
    if graph.hub_edges is not None:
        # Fewer than n_edges / hub_degree rows, see hot_threshold.
        hubs = shares.where(F.col("out_degree") > graph.hub_degree)
        received = received.union(
            graph.hub_edges.join(F.broadcast(hubs), "src").select(counts)
        )
    contrib = _sum_of_counts(F.col("coarse"), F.col("fine"))
    return received.groupBy("dst").agg(contrib.alias("contrib"))


def masses() -> dict[str, Column]:
    """Aggregates over a state: all rank, and the rank held by pages without outlinks."""
    held_by_sinks = exact_sum(F.when(F.col("out_degree") == 0, F.col("rank")))
    return {
        "total_mass": F.coalesce(exact_sum(F.col("rank")), F.lit(0.0)),
        "sink_mass": F.coalesce(held_by_sinks, F.lit(0.0)),
    }


def damped_update(
    state: DataFrame, contrib: DataFrame, sink_mass: float, n_nodes: int, damping: float = DAMPING
) -> DataFrame:
    """The next state; every page stays, also without inlinks."""
    from_sinks = sink_mass / n_nodes
    rejoined = state.join(
        contrib.withColumnRenamed("dst", "id").hint("shuffle_hash"), "id", "left"
    )
    received = F.expr("coalesce(contrib, 0D)") + from_sinks
    return rejoined.select("id", (1 - damping + damping * received).alias("rank"), "out_degree")


def rank_graph(
    graph: Graph | RankGraph,
    scratch: Scratch,
    *,
    iterations: int = ROUNDS,
    damping: float = DAMPING,
    snapshots: Iterable[int] | None = None,
    start: DataFrame | None = None,
    journal: Journal | None = None,
) -> Ranking:
    """Run the rounds; keep the states of the rounds named in ``snapshots`` (the first and
    the last one unless given). Other states go once the next one is written.

    ``start`` holds ranks ``(id, rank)`` to go on from; every page starts at 1 without.
    With a ``journal``, whose ``scratch`` this one has to be, the layout and every round are
    recorded once they are stored, and what is recorded already is not done again: the run
    goes on from the last whole round that no missing snapshot lies before.
    """
    if isinstance(graph, Graph):
        graph = _laid_out(graph, scratch, journal)
    snapshots = checked_snapshots({1, iterations} if snapshots is None else snapshots, iterations)
    state = initial_state(graph)
    if graph.n_nodes == 0:
        return Ranking(graph, dict.fromkeys(snapshots, state))
    mass = {
        "total_mass": INITIAL_RANK * graph.n_nodes,
        "sink_mass": INITIAL_RANK * graph.n_sinks,
    }
    metric_rows = []
    with shuffle_partitions(scratch.spark, graph.buckets):
        states, done = _recorded_rounds(scratch, journal, snapshots, iterations)
        if done:
            state, mass, metric_rows = states[done["round"]], done["mass"], done["metric_rows"]
            log.info("going on after round %d", done["round"])
        elif start is not None:
            state, mass = _stored_start(graph, start, scratch)
            _check_mass(0, mass["total_mass"], graph.n_nodes)
        if 0 in snapshots or not done:
            states[0] = state if not done else initial_state(graph)
        for number in range(done["round"] + 1 if done else 1, iterations + 1):
            metric_rows.append((number, mass["total_mass"], mass["sink_mass"]))
            update = damped_update(
                state, contributions(state, graph), mass["sink_mass"], graph.n_nodes, damping
            )
            state, mass = scratch.save_bucketed(
                update, f"round_{number}", "id", graph.buckets, masses()
            )
            _check_mass(number, mass["total_mass"], graph.n_nodes)
            log.info("round %d: entering sink mass %r", number, metric_rows[-1][2])
            if journal is not None:
                facts = {"state": scratch.facts(state), "mass": mass, "metric_rows": metric_rows}
                journal.write(f"round_{number}", facts)
            states[number] = state
            if number - 1 not in snapshots:
                if journal is not None:
                    journal.forget(f"round_{number - 1}")
                scratch.drop_bucketed(states.pop(number - 1))
    return Ranking(graph, {n: states[n] for n in snapshots}, metric_rows)


def _laid_out(graph: Graph, scratch: Scratch, journal: Journal | None) -> RankGraph:
    """``prepare_ranking``, or what a journal has of it."""
    facts = journal.read("layout") if journal is not None else None
    if facts is not None:
        tables = {k: facts[k] and scratch.reopen(facts[k]) for k in ("vertices", "edges", "hub_edges")}
        return RankGraph(**{**facts, **tables})
    laid_out = prepare_ranking(graph, scratch)
    if journal is not None:
        facts = {f.name: getattr(laid_out, f.name) for f in fields(laid_out)}
        tables = {k: v if v is None else scratch.facts(v) for k, v in facts.items() if k in ("vertices", "edges", "hub_edges")}
        journal.write("layout", {**facts, **tables})
    return laid_out


def _recorded_rounds(
    scratch: Scratch, journal: Journal | None, snapshots: set[int], iterations: int
) -> tuple[dict[int, DataFrame], dict | None]:
    """The states to keep of a journal's rounds, and its last round that can be gone on from."""
    records = {} if journal is None else {k: journal.read(f"round_{k}") for k in range(1, iterations + 1)}
    records = {k: facts for k, facts in records.items() if facts is not None}
    ends = [k for k in records if all(n in records for n in snapshots if 0 < n <= k)]
    if not ends:
        return {}, None
    last = max(ends)
    kept = {k: scratch.reopen(records[k]["state"]) for k in records if k == last or k in snapshots and k < last}
    rows = [tuple(row) for row in records[last]["metric_rows"]]
    return kept, {"round": last, "mass": records[last]["mass"], "metric_rows": rows}


def checked_snapshots(snapshots: Iterable[int], iterations: int) -> set[int]:
    snapshots = set(snapshots)
    if not snapshots <= set(range(iterations + 1)):
        raise ValueError(f"snapshots {sorted(snapshots)} outside rounds 0 to {iterations}")
    return snapshots


def _check_mass(number: int, total_mass: float, n_nodes: int) -> None:
    """Every round keeps the total mass at the number of pages."""
    if abs(total_mass - n_nodes) > 1e-9 * n_nodes:
        raise RuntimeError(f"round {number}: total mass {total_mass!r}, expected {n_nodes}")
