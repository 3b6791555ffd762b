"""The registered queries in ANSI SQL, over the trade tables as views."""

from __future__ import annotations

# Fixed values, stated here again so that the oracle does not follow the engine.
DAMPING = 0.85
ROUNDS = 8

_GRAPH = """
nodes as (
  select 'C' || c_custkey as id from customer where c_acctbal > 0
  union all
  select 'S' || s_suppkey from supplier
  union all
  select 'P' || p_partkey from part
),
raw_links as (
  select case when l_returnflag = 'A' then 'S' || l_suppkey else 'C' || o_custkey end as src,
    case when l_returnflag = 'A' then 'C' || o_custkey
         when l_returnflag = 'R' then 'S' || l_suppkey else 'P' || l_partkey end as dst
  from lineitem join orders on l_orderkey = o_orderkey
),
page_links as (select * from raw_links where src in (select id from nodes)),
edges as (select distinct * from page_links where dst in (select id from nodes)),
degrees as (select src, count(*) as out_degree from edges group by src)
"""

# What the rendered wiki pages hold: title "C 12", wiki id "C_12".
_WIKI = """
written as (
  select replace(left(src, 1) || ' ' || substr(src, 2), ' ', '_') as src,
         left(dst, 1) || ' ' || substr(dst, 2) as target,
         case when cast(substr(dst, 2) as bigint) % 2 = 1 then '' else '|label' end as label
  from page_links
),
noise as (
  select left(id, 1) || '_' || substr(id, 2) as src, raw
  from nodes, (values ('File:x.png|see [[S 1'), ('S 1#h'), ('S 1/t')) as v(raw)
  union all
  select left(id, 1) || '_' || substr(id, 2), left(id, 1) || '_' || substr(id, 2) from nodes
)
"""


def _rounds(rounds: int) -> str:
    """One materialised CTE per round, ``rank_0`` to ``rank_<rounds>``."""
    steps = [
        "state_0 as materialized (select id, 1.0::double as rank, "
        "coalesce(out_degree, 0) as out_degree "
        "from nodes left join degrees on id = src)"
    ]
    for k in range(1, rounds + 1):
        before = f"state_{k - 1}"
        steps.append(
            f"""state_{k} as materialized (
  select s.id,
         {1 - DAMPING!r} + {DAMPING!r} * (coalesce(c.contrib, 0) + m.sink / m.n) as rank,
         s.out_degree
  from {before} s
  left join (select dst, sum(rank / out_degree) as contrib
             from {before} join edges on id = src group by dst) c on s.id = c.dst
  cross join (select count(*) as n,
                     coalesce(sum(case when out_degree = 0 then rank end), 0) as sink
              from {before}) m
)"""
        )
    return ",\n".join(steps)


def _exact_sum(value: str) -> str:
    """A sum that does not hang on the order of its rows: whole counts of two units."""
    coarse, fine = float(1 << 20), float(1 << 32)
    rest = f"({value} * {coarse!r}::double - floor({value} * {coarse!r}::double))"
    return (
        f"(cast(sum(cast(floor({value} * {coarse!r}::double) as bigint)) as double) / {coarse!r}::double"
        f" + cast(sum(cast(floor({rest} * {fine!r}::double) as bigint)) as double) / {coarse * fine!r}::double)"
    )


def _exact_rounds(rounds: int) -> str:
    """As ``_rounds``, equal to the last bit wherever the same sums are formed."""
    steps = [
        "exact_0 as materialized (select id, 1.0::double as rank, "
        "coalesce(out_degree, 0) as out_degree from nodes left join degrees on id = src)"
    ]
    held = "case when out_degree = 0 then rank end"
    for k in range(1, rounds + 1):
        before = f"exact_{k - 1}"
        steps.append(
            f"""exact_{k} as materialized (
  select s.id,
         {1 - DAMPING!r}::double + {DAMPING!r}::double
           * (coalesce(c.contrib, 0::double) + m.sink / cast(m.n as double)) as rank,
         s.out_degree
  from {before} s
  left join (select dst, {_exact_sum("(rank / cast(out_degree as double))")} as contrib
             from {before} join edges on id = src group by dst) c on s.id = c.dst
  cross join (select count(*) as n, coalesce({_exact_sum(f"({held})")}, 0) as sink from {before}) m
)"""
        )
    return ",\n".join(steps)


def _ranks(rounds: int, tail: str) -> str:
    return f"with {_GRAPH}, {_rounds(rounds)} {tail}"


def _with_graph(tail: str) -> str:
    return f"with {_GRAPH} {tail}"


def _with_wiki(tail: str) -> str:
    return f"with {_GRAPH}, {_WIKI} {tail}"


_BLOCKS = _with_graph("select count(*) + count(*) filter (id like 'C%') as n_blocks from nodes")
_WIKI_ID = "left({0}, 1) || '_' || substr({0}, 2)"
_MASSES = " union all ".join(
    f"select {k + 1} as iteration, round(sum(rank), 6) as total_mass, "
    "round(coalesce(sum(case when out_degree = 0 then rank end), 0), 6) as sink_mass "
    f"from state_{k}"
    for k in range(ROUNDS)
)
_EXACT_MASSES = " union all ".join(
    f"select {k + 1} as iteration, {_exact_sum('rank')} as total_mass, "
    f"coalesce({_exact_sum('(case when out_degree = 0 then rank end)')}, 0) as sink_mass from exact_{k}"
    for k in range(ROUNDS)
)
_OUTLINKS = (
    "select id, count(dst) as n_out, coalesce(string_agg(dst, ' ' order by dst), '') as outlinks "
    "from nodes left join edges on id = src group by id"
)

_INLINKS = (
    "select dst as id, count(*) as n_in, string_agg(src, ' ' order by src) as inlinks "
    "from edges group by dst"
)
_WIKI_OUTLINKS = (
    f"select {_WIKI_ID.format('id')} as key, "
    f"coalesce(string_agg({_WIKI_ID.format('dst')}, ' ' order by dst), '') as value "
    "from nodes left join edges on id = src group by id"
)
_NUMBERS = "select id, cast(row_number() over (order by id) - 1 as int) as number from nodes"
_MALFORMED = (
    "select 'S' || s_suppkey || chr(9) || 'none S1' as value from supplier where s_suppkey % 3 = 0"
)
_CORRUPT = (
    "select 'P_' || p_partkey as title, p_partkey % 3 = 2 as is_corrupt, "
    "cast([1, 2, 0][1 + p_partkey % 3] as bigint) as n_links from part"
)

_DENSE_EDGES = (
    f"select s.number as src, d.number as dst from edges join ({_NUMBERS}) s on src = s.id "
    f"join ({_NUMBERS}) d on dst = d.id"
)

_QUARANTINED_LINES = """
select 'S' || s_suppkey as id,
  ['rank is no number', 'no rank', 'no rank', 'page'][1 + s_suppkey % 4] as reason,
  case when s_suppkey % 4 = 3 then 2 end::bigint as n_out,
  (select count(*) filter (s_suppkey % 4 = 3) || ' ' || count(*) filter (s_suppkey % 4 in (1, 2))
     || ' ' || count(*) filter (s_suppkey % 4 = 0) from supplier) as counts
from supplier
"""
_QUARANTINED_PAGES = """
select case when p_partkey % 4 = 2 then 'broken markup' else 'no title' end as reason, p_partkey as number,
  case when p_partkey % 4 = 2 then 'P_' || p_partkey else '' end as id,
  (select count(*) from part where p_partkey % 4 in (0, 1)) as n_untitled,
  (select count(*) from part where p_partkey % 4 = 2) as n_corrupt
from part where p_partkey % 4 <> 3
"""

ORACLE_SQL = {
    "replaced_results": _with_graph(
        "select 'outlinks' as result, count(*) as n_rows from nodes "
        "union all select 'ranking_1', count(*) from nodes union all select 'notes', count(*) from nodes "
        "union all select 'n', 1 union all select 'masses', 1"
    ),
    "rank_completeness": _with_graph(
        "select count(*) as n_pages, count(*) as n_ranked, 0::bigint as n_apart from nodes"
    ),
    "quarantined_lines": _QUARANTINED_LINES,
    "quarantined_pages": _QUARANTINED_PAGES,
    "neighbour_blocks": _with_graph(_DENSE_EDGES),
    "neighbours_of_pages": _with_graph(
        f"select * from ({_DENSE_EDGES}) where src < 10 or src between 200 and 230"
    ),
    "block_scan_parts": _BLOCKS,
    "corrupt_pages": _CORRUPT,
    "malformed_lines": _MALFORMED,
    "red_link_filter_hot": _with_graph("select src, dst from edges"),
    "ranking_hubs": _ranks(8, "select id, round(rank, 6) as rank from state_8"),
    "dump_ranking_1": _ranks(
        1, f"select {_WIKI_ID.format('id')} as id, round(rank, 6) as rank from state_1"
    ),
    "dump_outlinks": _with_graph(_WIKI_OUTLINKS),
    "dump_totals": _ranks(
        ROUNDS - 1,
        f"select iteration, total_mass, sink_mass, (select 'N=' || count(*) from nodes) as line from ({_MASSES})",
    ),
    "block_scan": _BLOCKS,
    "block_scan_gzip": _BLOCKS,
    "block_scan_bzip2": _BLOCKS,
    "parse_pages": _with_graph(f"select {_WIKI_ID.format('id')} as title, 1 as n_texts from nodes"),
    "extract_links": _with_wiki(
        "select src, target || label as raw from written union all select src, raw from noise"
    ),
    "filter_links": _with_wiki("select src, replace(target, ' ', '_') as dst from written"),
    "dump_edges": _with_graph(
        f"select {_WIKI_ID.format('src')} as src, {_WIKI_ID.format('dst')} as dst from edges"
    ),
    "dump_edges_parts": _with_graph(
        f"select {_WIKI_ID.format('src')} as src, {_WIKI_ID.format('dst')} as dst from edges"
    ),
    "ranked_pages_parts": f"with {_GRAPH}, {_exact_rounds(1)} select id, rank, out_degree as n_out from exact_1",
    "red_link_filter": _with_graph("select src, dst from edges"),
    "inlink_lists": _with_graph(_INLINKS),
    "outlink_lists": _with_graph(_OUTLINKS),
    "inlink_lists_parts": _with_graph(_INLINKS),
    "outlink_lists_parts": _with_graph(_OUTLINKS),
    "page_count": _with_graph("select count(*) as n from nodes"),
    "count_property": _with_graph("select 'N=' || count(*) as line from nodes"),
    "out_degrees": _with_graph("select src, out_degree from degrees"),
    "rank_init": _with_graph(
        "select id, 1.0::double as rank, coalesce(out_degree, 0) as n_out "
        "from nodes left join degrees on id = src"
    ),
    "contributions": _with_graph(
        "select dst as id, round(sum(1.0::double / out_degree), 6) as contrib "
        "from edges join degrees using (src) group by dst"
    ),
    "mass_by_round": _ranks(ROUNDS - 1, _MASSES),
    "rank_round_1": _ranks(1, "select id, round(rank, 6) as rank from state_1"),
    "rank_round_8": _ranks(8, "select id, round(rank, 6) as rank from state_8"),
    "ranking": _ranks(
        8,
        "select row_number() over (order by round(rank, 6) desc, id) as position, "
        "id, round(rank, 6) as rank from state_8",
    ),
    "dense_ids": _with_graph(f"select id, number from ({_NUMBERS})"),
    "dense_edges": _with_graph(_DENSE_EDGES),
    "exact_ranking": f"with {_GRAPH}, {_exact_rounds(ROUNDS)} select row_number() over "
    f"(order by rank desc, id) as position, id, rank from exact_{ROUNDS}",
    "journal_resume": f"with {_GRAPH}, {_exact_rounds(ROUNDS)} select id, rank from exact_{ROUNDS}",
    "published_ranking": f"with {_GRAPH}, {_exact_rounds(ROUNDS)} "
    f"select {_WIKI_ID.format('id')} as id, rank from exact_{ROUNDS}",
    "exact_masses": f"with {_GRAPH}, {_exact_rounds(ROUNDS - 1)} {_EXACT_MASSES}",
    "kv_text_roundtrip": _with_graph(f"select id as key, outlinks as value from ({_OUTLINKS})"),
    "adjacency_text_links": _with_graph("select src, dst from edges"),
    "ranked_page_roundtrip": _ranks(
        1, "select id, round(rank, 6) as rank, out_degree as n_out from state_1"
    ),
    "initial_page_lines": _with_graph(
        f"select id, 1.0::double as rank, outlinks from ({_OUTLINKS})"
    ),
    "resumed_ranking": _ranks(ROUNDS, f"select id, round(rank, 6) as rank from state_{ROUNDS}"),
    "dump_ranking": _ranks(
        ROUNDS, f"select {_WIKI_ID.format('id')} as id, round(rank, 6) as rank from state_{ROUNDS}"
    ),
}
