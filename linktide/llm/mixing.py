"""Mixing sources to target weights by Pareto order sampling, with built-in functions only."""

from __future__ import annotations

from dataclasses import dataclass
from math import lcm

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linktide.llm.common import WORD, table, text_of
from linktide.scratch import Scratch

WEIGHTS = (5, 2, 1)
MAX_COPIES = 2
SEED = "mix"
ROWS_PER_BUCKET = 50_000
# Sources up to which the table of targets, one row each, is broadcast.
BROADCAST_SOURCES = 100_000
_DRAWN = "array<struct<after_q:double,after_key:string,most:long,until_q:double,until_key:string>>"


@dataclass(frozen=True)
class Mix:
    """What to take: one row per source, and the columns it is applied to."""

    sources: DataFrame  # of, source_size, target, copies, want, scale, drawn, out_key, in_key
    seed: str
    broadcast: bool


def _size() -> Column:
    return F.regexp_count(text_of(), F.lit(WORD)).cast("long")


def _order(seed: str) -> tuple[Column, Column]:
    """``(u, key)``: a uniform number in (0, 1) by doc_id, and a key that breaks ties."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, 13)
    u = (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))
    return u, F.concat_ws(":", digits, name, F.md5(text_of()))


def _odds(p: Column) -> Column:
    return p / (F.lit(1.0) - p)


def source_targets(
    totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_percent: int = 150,
    max_copies: int = MAX_COPIES,
) -> DataFrame:
    """``(source, source_size, target)`` of ``totals(source, source_size)``.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    ``share_percent`` of all sizes by weight. No target is above ``max_copies`` times its
    source; what is left over is shared again by weight until none is above. Sources are
    filled in the order in which they reach their limit, so one pass finds all limits.
    The windows are over one narrow row per source.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (turn + 1).cast("int"))
    # All sizes in hundredths, so that they stay whole numbers.
    rows = totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * (100 * max_copies))
    reached = F.col("cap") * (F.lit(lcm(*weights)).cast("long") / F.col("weight")).cast("long")
    rows = rows.withColumn("reached", reached)
    everything = Window.partitionBy()
    before = Window.orderBy("reached", F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    wide = "decimal(20,0)"
    rows = (
        rows.withColumn("share", F.sum("source_size").over(everything) * share_percent)
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("left", F.col("share") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("left_weight", F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )
    above = F.col("left").cast(wide) * F.col("weight").cast("decimal(18,0)") > F.col("cap").cast(
        wide
    ) * F.col("left_weight").cast("decimal(18,0)")
    rows = rows.withColumn("capped", above)
    free = F.when(~F.col("capped"), F.col("weight"))
    rows = rows.withColumn("free_weight", F.sum(free).over(everything)).withColumn(
        "rest", F.col("share") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0))
    )
    shared = (F.col("rest") * F.col("weight")).cast("double") / (F.col("free_weight") * 100).cast("double")
    limit = (F.col("source_size") * max_copies).cast("double")
    return rows.select("source", "source_size", F.when(F.col("capped"), limit).otherwise(shared).alias("target"))


def plan_mix(
    docs: DataFrame, scratch: Scratch, *, weights: tuple[int, ...] = WEIGHTS, share_percent: int = 150,
    max_copies: int = MAX_COPIES, seed: str = SEED, rows_per_bucket: int = ROWS_PER_BUCKET,
) -> tuple[Mix, DataFrame]:
    """Decide what to take of ``docs(doc_id, text, source)``; also return their sizes.

    Each document is taken ``floor(target / source_size)`` certain whole times. What is then
    left of the target, in whole words, is a Pareto sample without replacement: a document's
    chance p is in proportion to its size, those that come out at 1 or more are certain and
    the others' chances rise in turn, until the expected words are the wanted ones. Documents
    are ranked by the odds of a random number divided by the odds of p, and taken in that
    order if their words fit what is still wanted; one longer than all that is wanted has no
    chance. What is missing in the end is closed by one exchange: the last of some size
    among the documents taken by chance, or none, for the first of another size among those
    left, whichever comes nearest to the target.

    A round takes documents no longer than the gap up to the first that does not fit, and
    the next one goes on behind that with the gap left, until nothing does not fit. The
    place is found without sorting a source: sizes are summed per source and bucket of
    the order, and only the bucket that holds it is ordered. The random
    number hangs on ``seed`` and doc_id only, so reruns agree. Rows that agree in doc_id
    and text are taken together. Sizes are words of white-space separated text; null and
    empty texts have none and take no part. A null source is a source. An empty table
    gives an empty plan.
    """
    u, key = _order(seed)
    sized = docs.select("doc_id", "source", _size().alias("size"), u.alias("u"), key.alias("key"))
    sized, seen = scratch.save(sized, "sizes", {"n": F.count(F.lit(1))})
    buckets = max(1, -(-seen["n"] // rows_per_bucket))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(totals, weights, share_percent, max_copies)
    copies = F.coalesce(F.floor(F.expr("try_divide(target, source_size)")), F.lit(0)).cast("long")
    targets = targets.withColumn("copies", copies).withColumn(
        "want", F.floor(F.col("target") - F.col("copies") * F.col("source_size") + 0.5).cast("long")
    )
    targets, found = scratch.save(targets.withColumnRenamed("source", "of"), "targets", {"n": F.count(F.lit(1))})
    small = found["n"] <= BROADCAST_SOURCES
    scales = _scales(sized, targets, small)
    targets, _ = scratch.save(
        targets.join(scales, F.col("of").eqNullSafe(F.col("scale_of")), "left").drop("scale_of"), "chances"
    )

    q = _pareto(F.col("u"))
    ranked = _with_source(sized, targets, small).withColumn("q", q).where("q is not null")
    place = F.least(F.floor(F.col("q") / (1 + F.col("q")) * buckets), F.lit(buckets - 1))
    ranked = ranked.select("source", "size", "key", "q", place.alias("bucket"))
    state = targets.where("want > 0").select(
        "of", F.col("want").alias("gap"), F.lit(None).cast("double").alias("after_q"),
        F.lit(None).cast("string").alias("after_key"), F.array().cast(_DRAWN).alias("drawn"), F.lit(True).alias("open"),
    )
    left = 1
    while left:
        state, seen = scratch.save(
            _round(ranked, state, scratch, small), "drawn", {"n": F.count_if(F.col("open") & (F.col("gap") >= 1))}
        )
        left = seen["n"]

    closing = _exchange(_with_source(sized, targets, small).withColumn("q", q), state, small)
    drawn = state.select(F.col("of").alias("drawn_of"), "drawn")
    sources = (
        targets.join(drawn, F.col("of").eqNullSafe(F.col("drawn_of")), "left")
        .join(closing, F.col("of").eqNullSafe(F.col("closing_of")), "left")
        .drop("closing_of", "drawn_of")
    )
    sources, _ = scratch.save(sources, "plan")
    return Mix(sources, seed, small), sized


def _scales(sized: DataFrame, targets: DataFrame, small: bool) -> DataFrame:
    """``(scale_of, scale)``: a document's chance is ``scale * size``, or 1 where that is more.

    From the longest size down, sizes are certain while an equal share for all that are
    left would give them a chance above 1. The window is over one row per source and size.
    """
    sizes = sized.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    sizes = _with_source(sizes, targets.select("of", "want"), small).where("size <= want")
    longer = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    size = F.col("size").cast("decimal(12,0)")
    wanted = F.col("want") - F.coalesce(F.sum(F.col("n") * F.col("size")).over(longer), F.lit(0))
    squares = F.sum(F.col("n").cast("decimal(14,0)") * size * size).over(rest)
    scale = wanted.cast("double") / squares.cast("double")
    fair = sizes.withColumn("scale", scale).where(F.col("scale") * F.col("size") <= 1)
    return fair.groupBy(F.col("source").alias("scale_of")).agg(F.max_by("scale", "size").alias("scale"))


def _pareto(u: Column) -> Column:
    """The ranking number of rows of ``_with_source``: 0 for certain documents, null for
    those that have no chance. Without a scale, all that could fit are certain."""
    p = F.coalesce(F.col("scale") * F.col("size"), F.lit(1.0))
    chance = (F.col("size") > 0) & (F.col("size") <= F.col("want"))
    return F.when(chance & (p >= 1), 0.0).when(chance, _odds(u) / _odds(F.least(p, F.lit(0.9999999999999999))))


def _with_source(docs: DataFrame, sources: DataFrame, small: bool) -> DataFrame:
    return docs.join(F.broadcast(sources) if small else sources, F.col("source").eqNullSafe(F.col("of"))).drop("of")


def _behind(q: str | Column, key: str | Column) -> Column:
    q, key = (F.col(c) if isinstance(c, str) else c for c in (q, key))
    return (F.col("q") > q) | ((F.col("q") == q) & (F.col("key") > key))


def _round(ranked: DataFrame, state: DataFrame, scratch: Scratch, small: bool) -> DataFrame:
    """``state(of, gap, after_q, after_key, drawn, open)`` after one more round.

    ``drawn`` has what each round took: what lies between two places and is no longer
    than ``most``; a null place is no bound. Only ``open`` sources go on. Rows that go
    together are summed, so several that are short enough alone may be what does not fit.
    """
    going = state.where("open").withColumn("most", F.col("gap"))
    fits = (F.col("size") <= F.col("most")) & F.coalesce(_behind("after_q", "after_key"), F.lit(True))
    rows = _with_source(ranked, going.drop("drawn", "open"), small).where(fits)
    sums = rows.groupBy("source", "bucket", "gap").agg(F.sum("size").alias("words"))
    sums = sums.withColumn("end", F.sum("words").over(Window.partitionBy("source").orderBy("bucket")))
    place = F.struct("bucket", (F.col("end") - F.col("words")).alias("before"))
    cut = sums.groupBy("source").agg(
        F.max("end").alias("total"), F.min(F.when(F.col("end") > F.col("gap"), place)).alias("cut")
    ).select(F.col("source").alias("cut_of"), "total", F.col("cut.bucket").alias("cut_bucket"), F.col("cut.before").alias("before"))
    cut, _ = scratch.save(cut, "cuts")
    at_cut = _with_source(rows, cut.withColumnRenamed("cut_of", "of"), small).where("bucket = cut_bucket")
    words = F.sum("size").over(Window.partitionBy("source").orderBy("q", "key"))
    end = at_cut.withColumn("end", F.col("before") + words).groupBy("source").agg(
        F.max(F.when(F.col("end") <= F.col("gap"), F.col("end"))).alias("end"),
        F.min(F.when(F.col("end") > F.col("gap"), F.struct("q", "key"))).alias("until"),
    ).withColumnRenamed("source", "end_of")
    taken = F.when(F.col("until").isNull(), F.coalesce("total", F.lit(0))).otherwise(F.coalesce("end", "before"))
    drawn = F.struct("after_q", "after_key", "most", F.col("until.q").alias("until_q"), F.col("until.key").alias("until_key"))
    gone = (
        going.join(cut, F.col("of").eqNullSafe(F.col("cut_of")), "left")
        .join(end, F.col("of").eqNullSafe(F.col("end_of")), "left")
        .select(
            "of", (F.col("gap") - taken).alias("gap"), F.col("until.q").alias("after_q"),
            F.col("until.key").alias("after_key"), F.concat("drawn", F.array(drawn)).cast(_DRAWN).alias("drawn"),
            F.col("until").isNotNull().alias("open"),
        )
    )
    return gone.unionByName(state.where("not open"))


def _is_drawn() -> Column:
    inside = F.exists(
        "drawn",
        lambda d: (F.col("size") <= d["most"])
        & F.coalesce(_behind(d["after_q"], d["after_key"]), F.lit(True))
        & F.coalesce(
            (F.col("q") < d["until_q"]) | ((F.col("q") == d["until_q"]) & (F.col("key") < d["until_key"])), F.lit(True)
        ),
    )
    return F.coalesce(F.col("q").isNotNull() & inside, F.lit(False))


def _exchange(rows: DataFrame, state: DataFrame, small: bool) -> DataFrame:
    """``(closing_of, out_key, in_key)``: the exchange that brings a source nearest to its target.

    A document taken by chance, of size a, or none (0), goes for one left, of size b, where
    ``gap + a - b`` is nearest to 0 and nearer than the gap. Of a size, the last in order goes
    and the first comes. The nearest b on either side is found in one sorted pass over
    the sizes of a source, as in a join of the nearest times.
    """
    rows = _with_source(rows.where("size > 0"), state.where("gap > 0").select("of", "gap", "drawn"), small)
    rows = rows.withColumn("inside", _is_drawn()).where("not inside or q > 0")
    # Documents without a place in the order come last.
    q = F.coalesce("q", F.lit(float("inf")))
    groups = rows.groupBy("source", "gap", "inside", q.alias("q"), "key").agg(F.sum("size").alias("size"))
    place = F.struct("q", "key")
    sizes = groups.groupBy("source", "gap", "inside", "size").agg(
        F.max(place).alias("last"), F.min(place).alias("first")
    )
    goes = sizes.where("inside").select("source", "gap", (F.col("gap") + F.col("size")).alias("value"), F.lit(1).alias("side"), F.col("size").alias("a"), F.col("last.key").alias("key"))
    none = state.where("gap > 0").select(F.col("of").alias("source"), "gap", F.col("gap").alias("value"), F.lit(1).alias("side"), F.lit(0).cast("long").alias("a"), F.lit(None).cast("string").alias("key"))
    comes = sizes.where("not inside").select("source", "gap", F.col("size").alias("value"), F.lit(0).alias("side"), F.lit(None).cast("long").alias("a"), F.col("first.key").alias("key"))
    offered = F.when(F.col("side") == 0, F.struct(F.col("value").alias("b"), F.col("key").alias("in_key")))
    order = Window.partitionBy("source").orderBy("value", "side")
    below = F.last(offered, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    above = F.first(offered, ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))
    points = goes.union(none).union(comes).withColumns({"below": below, "above": above}).where("side = 1")
    each = points.select("source", "gap", "value", "a", "key", F.explode(F.array("below", "above")).alias("come")).where("come is not null")
    error = F.abs(F.col("value") - F.col("come.b"))
    best = F.min(F.struct(error.alias("error"), F.col("a"), F.col("come.b").alias("b"), F.col("key").alias("out_key"), F.col("come.in_key").alias("in_key")))
    return each.where(error < F.col("gap")).groupBy(F.col("source").alias("closing_of")).agg(best.alias("best")).select(
        "closing_of", "best.out_key", "best.in_key"
    )


def _decided(rows: DataFrame) -> DataFrame:
    """Rows of ``_with_source`` with ``times``: how often each is taken."""
    rows = rows.withColumn("q", _pareto(F.col("u")))
    stays = _is_drawn() & F.coalesce(F.col("key") != F.col("out_key"), F.lit(True))
    extra = (F.col("size") > 0) & (stays | F.coalesce(F.col("key") == F.col("in_key"), F.lit(False)))
    return rows.withColumn("times", (F.col("copies") + extra.cast("int")).cast("long"))


def mixed_sizes(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``, one row per row of ``docs``."""
    mix, sized = plan_mix(docs, scratch, **options)
    rows = _decided(_with_source(sized, mix.sources, mix.broadcast))
    return rows.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken")
    )


def mix_documents(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; all columns are kept."""
    mix, _ = plan_mix(docs, scratch, **options)
    u, key = _order(mix.seed)
    inner = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "source",
        _size().alias("size"), u.alias("u"), key.alias("key"),
    )
    rows = _decided(_with_source(inner, mix.sources, mix.broadcast))
    return rows.select(F.explode(F.array_repeat("row", F.col("times").cast("int"))).alias("row")).select("row.*")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixed_sizes(docs, Scratch(spark))


OP6_SQL = r"""
with recursive sized as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
    substr(md5('mix:' || coalesce(cast(doc_id as varchar), '')), 1, 13) as digits,
    md5(coalesce(text, '')) as text_md5 from documents),
keyed as (
  select doc_id, source, size, (cast('0x' || digits as bigint) + 0.5::double) / 4503599627370496.0::double as u,
    digits || ':' || coalesce(cast(doc_id as varchar), '') || ':' || text_md5 as key from sized),
totals as (
  select source, cast(sum(size) as bigint) as source_size,
    [5, 2, 1][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight
  from keyed group by source),
filled as (
  select *, source_size * 200 as cap, sum(source_size) over () * 150 as share,
    sum(source_size) over () * 150 - coalesce(sum(source_size * 200) over before, 0) as remaining,
    sum(weight) over () - coalesce(sum(weight) over before, 0) as left_weight
  from totals
  window before as (order by source_size * 200 * (10 // weight), source nulls last
    rows between unbounded preceding and 1 preceding)),
limits as (select *, remaining * weight > cap * left_weight as capped from filled),
targets as (
  select source, source_size, case when capped then cast(source_size * 2 as double)
    else cast((share - coalesce(sum(cap) filter (capped) over (), 0)) * weight as double)
      / cast(sum(weight) filter (not capped) over () * 100 as double) end as target
  from limits),
wanted as (
  select *, cast(floor(target - copies * source_size + 0.5) as bigint) as want from (
    select *, case when source_size = 0 then 0 else cast(floor(target / source_size) as bigint) end as copies from targets)),
fitting as (
  select k.source, size, want, count(*) as n from keyed k join wanted w on k.source is not distinct from w.source
  where size > 0 and size <= want group by all),
scaled as (
  select source, size,
    cast(want - coalesce(sum(n * size) over (partition by source order by size desc
        rows between unbounded preceding and 1 preceding), 0) as double)
      / cast(sum(cast(n * size as hugeint) * size) over (partition by source order by size
        rows between unbounded preceding and current row) as double) as scale
  from fitting),
scales as (select source, max_by(scale, size) as scale from scaled where scale * size <= 1 group by source),
chances as (
  select k.*, source_size, target, copies, want,
    case when size > 0 and size <= want then coalesce(scale * size, 1) end as p
  from keyed k join wanted w on k.source is not distinct from w.source
  left join scales s on k.source is not distinct from s.source),
ranked as (
  select *, case when p >= 1 then 0::double else (u / (1.0::double - u)) / (p / (1.0::double - p)) end as q from chances),
ordered as (
  select source, key, q, sum(size) as size, max(size) as one, max(want) as want,
    row_number() over (partition by source order by q, key) as n
  from ranked where q is not null group by source, key, q),
walk as (
  select distinct source, 0::bigint as n, want as gap, null::varchar as key, false as inside from wanted where want > 0
  union all
  select w.source, o.n, case when o.size <= w.gap then w.gap - o.size else w.gap end, o.key, o.size <= w.gap
  from walk w join ordered o on o.source is not distinct from w.source and o.n = w.n + 1),
gaps as (select source, min(gap) as gap from walk group by source),
held as (
  select r.source, r.key, coalesce(r.q, 'infinity'::double) as q, sum(r.size) as size, max(g.gap) as gap,
    coalesce(bool_or(w.inside), false) as inside
  from ranked r join gaps g on r.source is not distinct from g.source and g.gap > 0
  left join walk w on w.source is not distinct from r.source and w.key = r.key
  where r.size > 0 group by r.source, r.key, r.q),
goes as (
  select source, size, arg_max(key, (q, key)) as out_key from held where inside and q > 0 group by source, size
  union all select source, 0, null from gaps where gap > 0),
comes as (
  select source, size, any_value(gap) as gap, arg_min(key, (q, key)) as in_key from held where not inside group by source, size),
closing as (
  select a.source, arg_min({'out': out_key, 'in': in_key}, (abs(gap + a.size - b.size), a.size, b.size)) as best
  from goes a join comes b on a.source is not distinct from b.source
  where abs(gap + a.size - b.size) < gap group by a.source)
select doc_id, r.size, source_size, target,
  cast(r.size * (copies + case when r.size > 0 and
    (coalesce(inside, false) and key_of is distinct from c.best['out'] or key_of = c.best['in'])
    then 1 else 0 end) as bigint) as taken
from (select *, key as key_of from ranked) r
left join walk w on w.source is not distinct from r.source and w.key = r.key and w.inside
left join closing c on c.source is not distinct from r.source
"""
