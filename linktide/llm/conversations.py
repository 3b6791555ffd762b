"""Repair of conversations whose turns break the order of roles, with an audit of edits."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linktide.llm.alternation import ASSISTANT, BLOCK_TURNS, START, advance, block_table, ended
from linktide.llm.common import table
from linktide.llm.crc_grams import sql_crc32
from linktide.scratch import Scratch

# Conversations with more turns are cut into pieces that several tasks align.
LONG_TURNS = 100_000
_BLANK = " \t\n\x0b\x0c\r"
_ORDERLY = {"su", "ua", "au"}
_FAULTS = ("blank", "duplicate", "truncated")
_ROWS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def damaged(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, gone, role, text)``: turns with faults by crc32 of ``conv_id:turn``.

    Nulls are one space. Of 20 remainders, 0 drops the turn (it stays as a row that is
    ``gone``, so that no conversation is lost), 1 empties its text, 2 takes the sentence
    ends out of it, 3 has it twice and 4 makes it the user's.
    """
    def name(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.pmod(F.crc32(F.concat_ws(":", name("conv_id"), name("turn")).cast("binary")), F.lit(20))
    text, role = name("text"), name("role")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    copies = F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))
    return rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), (kind == 0).alias("gone"),
        F.when(kind == 4, "user").otherwise(role).alias("role"), text.alias("text"), F.explode(copies).alias("copy"),
    ).drop("copy")


def intact(rows: DataFrame) -> DataFrame:
    """``rows(conv_id, turn, role, text)`` as ``damaged`` has them, without damage."""
    return rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.lit(False).alias("gone"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    )


class _Turns:
    """Faults, gaps and order of turns that come in ascending order."""

    def __init__(self):
        self.faults = dict.fromkeys(_FAULTS, 0)
        self.illegal = self.n_turns = 0
        self.first_turn = self.last_turn = None
        self.first_role = self.last_role = None

    def letter(self, turn: int | None, role: str, text: str, repeated: bool) -> str:
        """Count the turn; its letter for the alignment."""
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.n_turns = turn, self.n_turns + 1
        initial = role[:1]
        if self.first_role is None:
            self.first_role = initial
        else:
            self.illegal += self.last_role + initial not in _ORDERLY
        self.last_role = initial
        worded = text.rstrip(_BLANK)
        fault = "blank" if not worded else "duplicate" if repeated else None
        if fault is None and worded[-1] not in ".!?":
            fault = "truncated"
        if fault:
            self.faults[fault] += 1
        letter = initial if initial and initial in "sua" else "o"
        return "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter

    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.n_turns


class _Repaired:
    """The text of a repaired conversation, as a running digest."""

    def __init__(self):
        self.digest, self.empty, self.after = sha256(), True, START

    def copy(self) -> _Repaired:
        other = _Repaired()
        other.digest, other.empty, other.after = self.digest.copy(), self.empty, self.after
        return other

    def add(self, audit: str, turns: list[tuple[str, str]]) -> _Repaired:
        """Follow an audit; ``turns`` are the ones that it goes over."""
        at, lines = 0, []
        for edit in audit:
            role, text = ("", "") if edit == "I" else turns[at]
            at += edit != "I"
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if self.after == "u" else "user"
            self.after = role[:1]
            lines.append(f"{role}:{text}")
        if lines:
            self.digest.update(("" if self.empty else "\n").encode() + "\n".join(lines).encode())
            self.empty = False
        return self


class _Conversation(_Turns):
    """One conversation, held as a block of turns and the best paths before it."""

    def __init__(self, conv_id: int | None):
        super().__init__()
        self.conv_id, self.seen = conv_id, set()
        self.paths = {START: (0, "")}
        self.texts = {START: _Repaired()}
        self.letters, self.turns = [], []

    def add(self, turn: int | None, role: str, text: str) -> None:
        key = blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        self.letters.append(self.letter(turn, role, text, key in self.seen))
        self.seen.add(key)
        self.turns.append((role, text))
        if len(self.turns) > BLOCK_TURNS:  # the last block waits for the end
            rest = self.letters.pop(), self.turns.pop()
            self._close()
            self.letters, self.turns = [rest[0]], [rest[1]]

    def _close(self) -> None:
        found = advance(self.paths, block_table("".join(self.letters)))
        texts = {s: self.texts[before].copy().add(audit, self.turns) for s, (_, _, before, audit) in found.items()}
        self.paths = {s: p[:2] for s, p in found.items()}
        self.texts = texts

    def row(self) -> tuple:
        if self.turns:
            found = advance(self.paths, block_table("".join(self.letters)))
            cost, audit, state = ended({s: p[:2] for s, p in found.items()})
            _, whole, before, block = found[state]
            text = self.texts[before].add(block + audit[len(whole) :], self.turns)
        else:
            cost, audit, text = 0, "", self.texts[START]
        return (
            self.conv_id, self.gaps(), *self.faults.values(), self.illegal, cost, audit, text.digest.hexdigest(),
        )


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [f.strip().split(" ") for f in schema.split(",")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    arrays = [pa.array(list(c), kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _by_row(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple]:
    for batch in batches:
        for k in range(0, batch.num_rows, 512):
            part = batch.slice(k, 512)
            yield from zip(*[part.column(c).to_pylist() for c in columns], strict=True)


_ORDER = ("conv_id", "turn", "role", "text")


def _short(turns: DataFrame) -> DataFrame:
    """Whole conversations, each in one task that reads its turns in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for conv_id, turn, gone, role, text in _by_row(batches, ("conv_id", "turn", "gone", "role", "text")):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    rows.append(now.row())
                    if len(rows) >= 1000:
                        yield _batch(rows, _ROWS)
                        rows = []
                now = _Conversation(conv_id)
            if not gone:
                now.add(turn, role, text)
        if now is not None:
            rows.append(now.row())
        yield _batch(rows, _ROWS)

    return turns.repartition("conv_id").sortWithinPartitions(*_ORDER).mapInArrow(run, _ROWS)


_PIECES = (
    "conv_id long, piece long, first_turn long, last_turn long, n_turns long, first_role string, last_role string, "
    "blank long, duplicate long, truncated long, illegal long, before long, after long, cost long, audit string"
)


def _pieces(turns: DataFrame) -> DataFrame:
    """Conversations cut by ranges of turns: per piece and pair of states one row.

    Turns have ``earlier``: a turn with the same role and text, but a lower number, exists.
    Equal turns of one number are neighbours, as ranges never part rows that are equal.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, now, paths, letters, before = TaskContext.get().partitionId(), None, {}, [], None

        def close() -> None:
            block = block_table("".join(letters))
            for entry, found in paths.items():
                paths[entry] = {s: p[:2] for s, p in advance(found, block).items()}
            letters.clear()

        def rows(conv_id: int | None) -> pa.RecordBatch:
            if letters:
                close()
            told = (conv_id, piece, now.first_turn, now.last_turn, now.n_turns, now.first_role, now.last_role, *now.faults.values(), now.illegal)
            return _batch([(*told, e, s, *p) for e, found in paths.items() for s, p in found.items()], _PIECES)

        for conv_id, turn, role, text, earlier in _by_row(batches, (*_ORDER, "earlier")):
            if now is None or before[0] != conv_id:
                if now is not None:
                    yield rows(before[0])
                now, paths = _Turns(), {s: {s: (0, "")} for s in range(ASSISTANT + 1)}
            repeated = earlier or before == (conv_id, turn, role, text)
            letters.append(now.letter(turn, role, text, repeated))
            before = conv_id, turn, role, text
            if len(letters) == BLOCK_TURNS:
                close()
        if now is not None:
            yield rows(before[0])

    return turns.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER).mapInArrow(run, _PIECES)


def _put_together(pieces: DataFrame) -> DataFrame:
    """One row per conversation from its pieces; a group has some 10 rows a piece."""
    schema = _ROWS.replace(", repaired_sha256 string", "")

    def run(frame):
        paths, parts, turns = {START: (0, "")}, [], 0
        for _, rows in frame.sort_values("piece").groupby("piece"):
            block = {(r.before, r.after): (r.cost, r.audit) for r in rows.itertuples()}
            paths = {s: p[:2] for s, p in advance(paths, block).items()}
            parts.append(rows.iloc[0])
        cost, audit, _ = ended(paths)
        told = [p for p in parts if p.n_turns]
        for a, b in zip(told[:-1], told[1:], strict=True):
            turns -= a.last_turn == b.first_turn
        turns += sum(p.n_turns for p in told)
        gaps = told[-1].last_turn - told[0].first_turn + 1 - turns if told else 0
        illegal = sum(p.illegal for p in parts) + sum(
            a.last_role + b.first_role not in _ORDERLY for a, b in zip(parts[:-1], parts[1:], strict=True)
        )
        faults = [sum(p[f] for p in parts) for f in _FAULTS]
        conv_id = parts[0].conv_id
        row = (None if conv_id != conv_id else int(conv_id), *map(int, (gaps, *faults, illegal, cost)), audit)
        return _batch([row], schema).to_pandas()

    return pieces.groupBy("conv_id").applyInPandas(run, schema)


def _digests(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """``(conv_id, repaired_sha256)``: a digest is of one text, so its turns pass one task in
    order; none is held."""
    schema = "conv_id long, repaired_sha256 string"
    nothing = F.lit(None)
    heads = audits.select("conv_id", F.lit(0).alias("place"), nothing.cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"))
    told = turns.select("conv_id", F.lit(1).alias("place"), "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, audit, at, rows = None, "", 0, []
        conv = None

        def done() -> None:
            if now is not None:
                rows.append((conv, now.add(audit[at:], []).digest.hexdigest()))

        for conv_id, place, role, text in _by_row(batches, ("conv_id", "place", "role", "text")):
            if place == 0:
                done()
                now, audit, at, conv = _Repaired(), text, 0, conv_id
                continue
            end = at
            while audit[end] == "I":
                end += 1
            now.add(audit[at : end + 1], [(role, text)])
            at = end + 1
        done()
        yield _batch(rows, schema)

    order = ("conv_id", "place", "turn", "role", "text")
    return heads.union(told).repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, schema)


def repaired(turns: DataFrame, scratch: Scratch, long_turns: int = LONG_TURNS) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)``
    of ``turns`` as ``damaged`` or ``intact`` give them, one row per conversation.

    Turns stand in the order of their number, null first; turns that share one follow role
    and text. Their first fault counts: no character but white space, role and text seen
    earlier, or a last character that ends no sentence. Edits keep a turn (0), give it the
    other role (2), delete it (3, a must for blank and repeated ones) or insert an empty one
    (2); a truncated turn that stays costs 1. The audit is the cheapest edits' initials that
    leave the roles' initials in the order ``(s?(ua)+)?``, the ASCII-least of equal cost.

    A null conv_id is a conversation of its own; one whose turns are all gone has zeros, an
    empty audit and the digest of nothing, as have roles that are empty an initial that
    fits nowhere. Very long turns are one block at most at a time; an empty table gives an
    empty result. A conversation above ``long_turns`` turns is aligned in pieces by several
    tasks; only its digest needs one task to read it through.
    """
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    most, seen = scratch.save(sizes.where(F.col("n") > long_turns).select("conv_id"), "long", {"n": F.count(F.lit(1))})
    if not seen.get("n"):
        return _short(turns)
    # Fewer than rows / long_turns ids.
    asked = F.broadcast(most.withColumnRenamed("conv_id", "long_id"))
    is_long = F.col("conv_id").eqNullSafe(F.col("long_id"))
    short = _short(turns.join(asked, is_long, "left_anti"))
    there = turns.join(asked, is_long, "left_semi")
    gone = there.groupBy("conv_id").agg(F.min("gone").alias("all_gone")).where("all_gone").drop("all_gone")
    there = there.where("not gone").drop("gone")
    key = F.md5(F.concat_ws(":", F.length("role"), F.concat("role", "text")))
    place = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")
    firsts = there.groupBy(F.col("conv_id").alias("of"), key.alias("key")).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    flagged = there.withColumn("key", key).join(
        firsts.where("n > 1").withColumnRenamed("key", "of_key"),
        F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key")), "left",
    )
    flagged = flagged.select(*_ORDER, F.coalesce(place > F.col("first"), F.lit(False)).alias("earlier"))
    flagged, _ = scratch.save(flagged, "turns")
    pieces, _ = scratch.save(_pieces(flagged), "pieces")
    whole, _ = scratch.save(_put_together(pieces), "audits")
    digests = _digests(flagged, whole).withColumnRenamed("conv_id", "of")
    long = whole.join(digests, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    zeros = [F.lit(0).cast("long").alias(c) for c in ("gaps", *_FAULTS, "illegal", "cost")]
    nothing = gone.select("conv_id", *zeros, F.lit("").alias("audit"), F.lit(sha256().hexdigest()).alias("repaired_sha256"))
    return short.unionByName(long).unionByName(nothing)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(damaged(table(spark, sf_dir, "conversations")), Scratch(spark))


OP12_SQL = rf"""
with recursive named as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as name from conversations),
kinds as (select *, {sql_crc32('name')} % 20 as kind from named),
hurt as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from kinds, unnest(range(case kind when 0 then 0 when 3 then 2 else 1 end)) as copies(k)),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as n from hurt),
judged as (
  select *, left(role, 1) as initial, regexp_replace(text, '[\x20\x09-\x0D]+$', '') as worded,
    row_number() over (partition by conv_id, role, text order by n) > 1 as again,
    left(lag(role) over (partition by conv_id order by n), 1) as previous from placed),
faulty as (
  select *, case when worded = '' then 'blank' when again then 'duplicate'
    when right(worded, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault from judged),
turns as (
  select *, fault in ('blank', 'duplicate') as goes, (fault = 'truncated')::bigint as more from faulty),
inserts(state, k, opened) as (values
  ('', 0, ''), ('', 1, 'u'), ('', 2, 'a'), ('', 3, 'u'), ('s', 0, 's'), ('s', 1, 'u'), ('s', 2, 'a'), ('s', 3, 'u'),
  ('u', 0, 'u'), ('u', 1, 'a'), ('u', 2, 'u'), ('a', 0, 'a'), ('a', 1, 'u'), ('a', 2, 'a')),
walk as (
  select distinct conv_id, 0::bigint as n, '' as state, {{'cost': 0::bigint, 'audit': ''}} as best from conversations
  union all
  select conv_id, n, after, min({{'cost': cost, 'audit': audit}}) from (
    select w.conv_id, t.n, e.after, w.best.cost + 2 * i.k + e.cost as cost,
      w.best.audit || repeat('I', i.k) || e.edit as audit
    from walk w join turns t on t.conv_id is not distinct from w.conv_id and t.n = w.n + 1
    join inserts i on i.state = w.state,
    lateral (
      select 'D' as edit, 3 as cost, i.opened as after
      union all
      select case when t.initial = wanted then 'K' else 'R' end, t.more + case when t.initial = wanted then 0 else 2 end, wanted
      from (select case when i.opened = 'u' then 'a' else 'u' end as wanted) where not t.goes
      union all
      select 'K', t.more, 's' where not t.goes and i.opened = '' and t.initial = 's') as e)
  group by conv_id, n, after),
ends as (
  select w.conv_id, min({{'cost': best.cost + e.cost, 'audit': best.audit || e.audit}}) as best
  from walk w join (select conv_id, max(n) as n from walk group by conv_id) m
    on m.conv_id is not distinct from w.conv_id and m.n = w.n
  join (values ('', 0, ''), ('s', 4, 'II'), ('u', 2, 'I'), ('a', 0, '')) as e(state, cost, audit) on e.state = w.state
  group by w.conv_id),
edits as (
  select conv_id, best.audit[p] as edit, p, p - length(replace(best.audit[1:p], 'I', '')) as inserted
  from ends, unnest(range(1, length(best.audit) + 1)) as places(p)),
kept as (
  select e.conv_id, e.p, e.edit, t.role, t.text, row_number() over (partition by e.conv_id order by e.p) as line
  from edits e left join turns t on t.conv_id is not distinct from e.conv_id and e.edit <> 'I' and t.n = e.p - e.inserted
  where e.edit <> 'D'),
lined as (
  select *, line - max(case when line = 1 and edit = 'K' and left(role, 1) = 's' then 1 else 0 end) over (partition by conv_id) as spot
  from kept),
texts as (
  select conv_id, string_agg(
    case when edit = 'K' then role when spot % 2 = 1 then 'user' else 'assistant' end || ':' ||
    case when edit = 'I' then '' else text end, chr(10) order by p) as text
  from lined group by conv_id),
told as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
    count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (n > 1 and previous || initial not in ('su', 'ua', 'au')) as illegal
  from turns group by conv_id)
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, best.cost as cost, best.audit as audit,
  sha256(coalesce(x.text, '')) as repaired_sha256
from ends e left join told t on t.conv_id is not distinct from e.conv_id
left join texts x on x.conv_id is not distinct from e.conv_id
"""
