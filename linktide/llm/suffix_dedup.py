"""Removal of repeated passages: every byte covered by a string that occurs twice."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linktide.llm.common import mixed, span_hashes, table, text_blocks
from linktide.llm.membership import IdFilter
from linktide.llm.suffix_order import suffix_array
from linktide.operators.skew import lookup
from linktide.scratch import Scratch

LENGTH = 400
GROUP_ROWS = 20_000
BLOCK_SYMBOLS = 100_000
_GRAM = 16


@dataclass(frozen=True)
class Cut:
    """How windows of ``length`` bytes are dealt out.

    The anchor of a window is the place with the least hash of a ``_GRAM``-byte string
    among its first ``reach`` places (the first such place). It depends on the window
    alone, so equal windows have equal anchors at equal places in them. All windows with
    one anchor follow each other (a run), and all hold the ``core`` bytes from it on.
    """

    length: int

    def __post_init__(self) -> None:
        if self.length < 2 * _GRAM:
            raise ValueError(f"passages of at least {2 * _GRAM} bytes")

    @property
    def reach(self) -> int:
        return max(1, min(self.length * 2 // 5, self.length - _GRAM + 1))

    @property
    def core(self) -> int:
        return self.length - self.reach + 1


def _least_places(data: np.ndarray, reach: int) -> np.ndarray:
    """For each place, the place of the least gram among the ``reach`` from it on."""
    padded = np.concatenate([data, np.zeros(2 * _GRAM, np.uint8)])
    words = np.ndarray((len(data) + _GRAM,), "<u8", padded.tobytes(), strides=(1,))
    h = mixed(words[: len(data)] * np.uint64(0x9E3779B97F4A7C15) ^ words[8 : len(data) + 8])
    least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(data), dtype=np.uint64)
    span = 1
    while 2 * span <= reach:
        least[:-span] = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = reach - span
    if rest:
        least[:-rest] = np.minimum(least[:-rest], least[rest:])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _repeating(data: np.ndarray, ends: np.ndarray, starts: np.ndarray, length: int):
    """``(repeated, told)`` per window: it stands again up to ``_GRAM`` bytes on or before;
    an equal one stands that near before it. ``ends`` are those of the windows' rows."""
    repeated, told = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    for period in range(1, _GRAM + 1):
        differ = np.concatenate([[0], np.cumsum(data[:-period] != data[period:], dtype=np.int32)])
        inside = np.flatnonzero(starts + length + period <= ends)
        begin = starts[inside]
        same = inside[differ[begin + length] == differ[begin]]
        repeated[same] = repeated[same + period] = told[same + period] = True
    return repeated, told


def _runs(data: np.ndarray, offsets: np.ndarray, cut: Cut):
    """``(row, low, high, anchor, key)`` per run and ``(row, start, end)`` per passage that
    repeats itself at once, places counted from the row's start.

    Where letters repeat in short periods every window has an anchor of its own. Of equal
    windows a few bytes apart only the first is told then, and all are marked here.
    """
    last = offsets[1:] - cut.length  # the last window of each row
    counts = np.maximum(0, last - offsets[:-1] + 1)
    total = int(counts.sum())
    nothing = np.zeros(0, np.int64)
    if not total:
        return (*(nothing,) * 4, np.zeros(0, np.uint64)), (nothing,) * 3
    sums = np.concatenate([[0], np.cumsum(counts)])
    rows = np.repeat(np.arange(len(counts)), counts)
    starts = np.arange(total) + (offsets[:-1] - sums[:-1])[rows]
    anchors = _least_places(data, cut.reach)[starts]

    def firsts() -> np.ndarray:
        fresh = np.ones(len(starts), bool)
        fresh[1:] = (anchors[1:] != anchors[:-1]) | (rows[1:] != rows[:-1]) | (starts[1:] != starts[:-1] + 1)
        return np.flatnonzero(fresh)

    first, passages = firsts(), (nothing,) * 3
    if len(first) * _GRAM > total:
        repeated, told = _repeating(data, offsets[1:][rows], starts, cut.length)
        at = np.flatnonzero(repeated)
        begins = at[np.concatenate([[True], (np.diff(at) > 1) | (np.diff(rows[at]) > 0)])] if len(at) else at
        ends = at[np.concatenate([(np.diff(at) > 1) | (np.diff(rows[at]) > 0), [True]])] if len(at) else at
        base = offsets[:-1][rows[begins]]
        passages = rows[begins], starts[begins] - base, starts[ends] + cut.length - base
        starts, anchors, rows = starts[~told], anchors[~told], rows[~told]
        first = firsts()
    high = np.concatenate([first[1:], [len(starts)]]) - 1
    row, anchor = rows[first], anchors[first]
    base = offsets[:-1][row]
    keys = span_hashes(data, anchor, anchor + cut.core)
    return (row, starts[first] - base, starts[high] - base, anchor - base, keys), passages


def text_runs(docs: DataFrame, cut: Cut) -> DataFrame:
    """``(doc_id, text_id, n_bytes, sha256, lows, highs, anchors, keys, starts, ends)`` per row."""
    names = ["lows", "highs", "anchors", "keys", "starts", "ends"]
    schema = "doc_id long, text_id binary, n_bytes long, sha256 string, " + ", ".join(f"{n} array<long>" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_blocks(batches, "text"):
            lists = []
            for row, *columns in _runs(data, offsets, cut):
                ends = pa.array(np.searchsorted(row, np.arange(len(offsets))), pa.int32())
                lists += [pa.ListArray.from_arrays(ends, pa.array(x.view(np.int64))) for x in columns]
            raw = memoryview(data.tobytes())
            digests = [hashlib.sha256(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"), pa.array([d.digest() for d in digests], pa.binary()),
                    pa.array(np.diff(offsets)), pa.array([d.hexdigest() for d in digests]), *lists,
                ],
                ["doc_id", "text_id", "n_bytes", "sha256", *names],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


_SEGMENT = "key binary, segment_id binary, segment binary, core long, core_size long, low long, high long"


def _holder() -> Column:
    """Of equal texts one is read: the one with the least doc_id (null: the least number)."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long"))


def _held_texts(docs: DataFrame, wanted: DataFrame, scratch: Scratch) -> DataFrame:
    """The columns of ``wanted(text_id, holder, ...)`` with ``data``, the text's bytes.

    A filter by holder keeps most other texts from being moved. Copies of a text differ
    in the join key, so they don't meet in one task.
    """
    def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_blocks(batches, "text"):
            raw = data.tobytes()
            texts = [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            ids = [hashlib.sha256(t).digest() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.binary()), rows.column("holder"), pa.array(texts, pa.binary())],
                ["text_id", "holder", "data"],
            )

    named = docs.select(_holder().alias("holder"), "text")
    texts, _ = IdFilter(wanted, "holder", scratch).split(named, "holder")
    texts = texts.mapInArrow(identified, "text_id binary, holder long, data binary")
    keys = ["text_id", "holder"]
    others = [c for c in ["data", *wanted.columns] if c not in keys]
    return texts.join(wanted, keys).groupBy(keys).agg(*[F.first(c).alias(c) for c in others])


def _candidates(docs: DataFrame, wanted: DataFrame, cut: Cut, scratch: Scratch) -> DataFrame:
    """The wanted runs with their bytes: ``(text_id, copies, at, ...segment)``.

    ``wanted(text_id, holder, copies, runs)``. A segment holds all windows of a run; its id is a
    128-bit digest of its bytes and its anchor's place.
    """
    schema = f"text_id binary, copies long, at long, {_SEGMENT}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(10)]
            size = 0
            for text_id, data, copies, runs in zip(*(batch.column(c).to_pylist() for c in ("text_id", "data", "copies", "runs")), strict=True):
                for r in runs:
                    segment = data[r["low"] : r["high"] + cut.length]
                    core = r["anchor"] - r["low"]
                    name = hashlib.blake2b(segment + core.to_bytes(8, "little"), digest_size=16).digest()
                    key = r["key"].to_bytes(8, "little", signed=True)
                    values = (text_id, copies, r["low"], key, name, segment, core, cut.core, 0, r["high"] - r["low"])
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                    size += len(segment)
                    if size > 16 << 20:
                        yield made(out)
                        out, size = [[] for _ in range(10)], 0
            if size:
                yield made(out)

    def made(columns: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], _NAMES
        )

    return _held_texts(docs, wanted, scratch).mapInArrow(run, schema)


_NAMES = ["text_id", "copies", "at", "key", "segment_id", "segment", "core", "core_size", "low", "high"]
_TYPES = [pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), *[pa.int64()] * 4]
_MARKS = "segment_id binary, first long, last long"


def _agreed(a: bytes, b: bytes) -> int:
    """The length of the longest common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def _common(parts: list[bytes]) -> int:
    """The length of the longest prefix that all have."""
    return _agreed(min(parts), max(parts))


def _shared_prefixes(parts: list[bytes]) -> list[int]:
    """For each, the length of the longest prefix that it shares with any other one."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    found = [0] * len(parts)
    for i, j in zip(order[:-1], order[1:], strict=True):
        agreed = _agreed(parts[i], parts[j])
        found[i] = max(found[i], agreed)
        found[j] = agreed
    return found


class _Order:
    """Collects groups of segments and finds windows that two of a group's segments share.

    What all segments of a group have around their core is one symbol with it, the
    middle. A window that starts before the middle is a suffix of its own; it is shared
    if it equals its neighbour in the order. Windows that start in the middle differ
    only behind it: those of two segments are equal as far as the bytes behind agree,
    which is the most for neighbours in the order of the middles. A segment's bytes around
    its middle take part as far as another segment of the group has them too, and one byte
    more behind, which settles the order: no window beyond can be shared.
    """

    def __init__(self, length: int):
        self.length = length
        self.clear()

    def clear(self) -> None:
        self.symbols: list[int] = []
        self.windows: list[tuple[int, int, int]] = []  # (place, segment number, window)
        self.middles: list[tuple[int, int, int, int]] = []  # (place, number, first, behind)
        self.segments: list[tuple[bytes, bytes, int]] = []
        self.found: list[tuple[int, int]] = []
        self.groups = 0

    def add(self, rows: list[dict]) -> None:
        middle = 258 + self.groups
        self.groups += 1
        left = [r["segment"][r["low"] : r["core"]][::-1] for r in rows]
        right = [r["segment"][r["core"] + r["core_size"] : r["high"] + self.length] for r in rows]
        before, after = _common(left), _common(right)
        shared_left, shared_right = _shared_prefixes(left), _shared_prefixes(right)
        for k, row in enumerate(rows):
            low, high, end = row["low"], row["high"], row["core"] + row["core_size"] + after
            number = len(self.segments)
            self.segments.append((row["segment_id"], row["segment"], high))
            base = len(self.symbols)
            first, reached = row["core"] - before, row["core"] - shared_left[k]  # of the middle, of the left
            self.symbols += [b + 2 for b in left[k][before : shared_left[k]][::-1]]
            self.windows += [(base + p - reached, number, p) for p in range(reached, min(first, high + 1))]
            self.middles.append((len(self.symbols), number, max(low, first), end))
            self.symbols.append(middle)
            self.symbols += [b + 2 for b in right[k][after : shared_right[k] + 1]]
            self.symbols.append(1)

    def _share(self, number: int, first: int, last: int) -> None:
        last = min(last, self.segments[number][2])
        self.found += [(number, p) for p in range(first, last + 1)]

    def marks(self) -> list[tuple[bytes, int, int]]:
        """``(segment_id, first, last)``: the shared windows, as ranges."""
        window_at: dict[int, tuple[int, int]] = {w[0]: w[1:] for w in self.windows}
        middle_at = {m[0]: m[1:] for m in self.middles}
        before, marked, last_middle = None, False, None
        for place in suffix_array([*self.symbols, 0]):
            if (here := window_at.get(place)) is not None:
                window = self.segments[here[0]][1][here[1] : here[1] + self.length]
                same = before is not None and before[0] == window
                if same:
                    if not marked:
                        self.found.append(before[1])
                    self.found.append(here)
                before, marked = (window, here), same
            elif (middle := middle_at.get(place)) is not None:
                number, first, end = middle
                behind = self.segments[number][1][end : self.segments[number][2] + self.length]
                symbol = self.symbols[place]
                if last_middle is not None and last_middle[0] == symbol:
                    agreed = _agreed(behind, last_middle[1])
                    for k, start, stop in (middle, last_middle[2]):
                        self._share(k, start, stop + agreed - self.length)
                last_middle = (symbol, behind, middle)
        ranges: list[list[int]] = []
        for number, p in sorted(set(self.found)):
            if ranges and ranges[-1][0] == number and ranges[-1][2] == p - 1:
                ranges[-1][2] = p
            else:
                ranges.append([number, p, p])
        return [(self.segments[k][0], a, b) for k, a, b in ranges]


def _shared(groups: DataFrame, cut: Cut) -> DataFrame:
    """``(segment_id, first, last)`` of windows that segments of one group share.

    Rows of a group stand next to each other in a partition; groups are sorted together
    in blocks of about ``BLOCK_SYMBOLS`` symbols.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, rows = _Order(cut.length), []

        def out() -> pa.RecordBatch:
            marks = order.marks()
            order.clear()
            columns = list(zip(*marks, strict=True)) or [[], [], []]
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())],
                ["segment_id", "first", "last"],
            )

        for batch in batches:
            for row in batch.to_pylist():
                if rows and rows[0]["key"] != row["key"]:
                    order.add(rows)
                    rows = []
                    if len(order.symbols) > BLOCK_SYMBOLS:
                        yield out()
                rows.append(row)
        if rows:
            order.add(rows)
        if order.symbols:
            yield out()

    return groups.repartition("key").sortWithinPartitions("key").mapInArrow(run, _MARKS)


def _refined(groups: DataFrame, cut: Cut) -> DataFrame:
    """Groups split by a longer core: about half of what a window has besides the core.

    Windows that reach far to the left of the core take that part in, the others have as
    much on the right. Equal windows stay together. After some eight splits the core is
    the whole window.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                at, size = row["core"], row["core_size"]
                rest = cut.length - size
                half = rest // 2 + 1
                # A window at p has at - p bytes before the core.
                left = (at - half, size + half, row["low"], min(row["high"], at - half))
                right = (at, size + rest - half + 1, max(row["low"], at - half + 1), row["high"])
                for core, new, low, high in (left, right):
                    if low <= high:
                        content = row["segment"][core : core + new]
                        key = hashlib.blake2b(content, digest_size=16).digest()
                        out.append(row | {"key": key, "core": core, "core_size": new, "low": low, "high": high})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=batch.schema)

    return groups.mapInArrow(run, _SEGMENT)


def shared_windows(segments: DataFrame, cut: Cut, scratch: Scratch, group_rows: int) -> DataFrame:
    """``(segment_id, first, last)`` of the windows that distinct segments share.

    A group (one key) of up to ``group_rows`` segments is sorted in one task. Larger ones
    are split by longer cores, until the core is the window and equal keys are repeats.
    """
    columns = [f.split()[0] for f in _SEGMENT.split(", ")]
    left, marks = segments.select(columns), []
    while True:
        counts = left.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        counts, _ = scratch.save(counts, "counts")
        counted, seen = scratch.save(left.join(counts, "key"), "groups", {"most": F.max("n")})
        full = F.col("core_size") == cut.length
        small = counted.where((F.col("n") <= group_rows) & ~full).select(columns)
        marks += [
            _shared(small, cut),
            counted.where(full).select("segment_id", F.col("low").alias("first"), F.col("high").alias("last")),
        ]
        if (seen["most"] or 0) <= group_rows:
            break
        left = _refined(counted.where((F.col("n") > group_rows) & ~full).select(columns), cut)
    found = marks[0]
    for more in marks[1:]:
        found = found.union(more)
    return found


def repeated_spans(
    docs: DataFrame, scratch: Scratch, *, length: int = LENGTH, group_rows: int = GROUP_ROWS
) -> tuple[DataFrame, DataFrame]:
    """``(rows, spans)`` for the repeated passages of whole texts.

    ``rows(doc_id, text_id, n_bytes, sha256)`` has one row per row of ``docs``; ``spans
    (text_id, spans)`` the byte ranges ``[start, end)`` of a text, merged and ascending,
    that are covered by a string of ``length`` bytes which starts anywhere else as well,
    in the same text or another. Null texts are empty; texts below ``length`` bytes have
    no spans; repeated rows repeat each other. An empty table gives empty results.

    Runs of windows whose core occurs once are done with. Equal texts are one text with
    copies, equal segments one segment. What is left, the ends of repeats, is ordered by
    a suffix array per group of segments with the same core.
    """
    cut = Cut(length)
    rows, _ = scratch.save(text_runs(docs, cut), "runs")
    lists = ["lows", "highs", "anchors", "keys"]
    texts = rows.where(F.size("keys") > 0).groupBy("text_id").agg(
        F.count(F.lit(1)).alias("copies"), F.min(_holder()).alias("holder"),
        *[F.first(c).alias(c) for c in lists],
    )
    zipped = F.arrays_zip(*[F.col(c) for c in lists])
    runs = texts.select("text_id", "holder", "copies", F.explode(zipped).alias("r")).select(
        "text_id", "holder", "copies", F.col("r.lows").alias("low"), F.col("r.highs").alias("high"),
        F.col("r.anchors").alias("anchor"), F.col("r.keys").alias("key"),
    )
    runs, _ = scratch.save(runs, "keys")
    # Stored, so that the join has a shuffle of its own, in which a hot key can be split.
    often = runs.groupBy("key").agg(F.sum("copies").alias("n")).where("n > 1").select("key")
    often, _ = scratch.save(often, "often")
    wanted = runs.join(often, "key").groupBy("text_id", "holder", "copies").agg(
        F.sort_array(F.collect_list(F.struct("low", "high", "anchor", "key"))).alias("runs")
    )
    wanted, _ = scratch.save(wanted, "wanted")
    held, seen = scratch.save(_candidates(docs, wanted, cut, scratch), "segments", {"n": F.count(F.lit(1))})

    kinds = held.groupBy("key", "segment_id").agg(F.sum("copies").alias("n"), F.max("high").alias("high"))
    kinds, _ = scratch.save(kinds, "kinds")
    whole = kinds.where("n > 1").select("segment_id", F.lit(0).cast("long").alias("first"), F.col("high").alias("last"))
    several = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("key")
    several, _ = scratch.save(several, "several")
    columns = ["segment", "core", "core_size", "low", "high"]
    compared = held.join(several, "key").groupBy("key", "segment_id").agg(
        *[F.first(c).alias(c) for c in columns]
    )
    shared = shared_windows(compared, cut, scratch, group_rows)
    # One row per segment; a segment has some hundred windows at most.
    marks = whole.union(shared.select(whole.columns)).groupBy(F.col("segment_id").alias("id")).agg(
        F.collect_set(F.struct("first", "last")).alias("marks")
    )
    marks, _ = scratch.save(marks, "marks")
    placed = held.select("segment_id", "text_id", "at")
    found = lookup(placed, "segment_id", marks, seen["n"], scratch).select("text_id", "at", F.explode("marks").alias("m"))
    spans = found.select("text_id", (F.col("at") + F.col("m.first")).alias("start"), (F.col("at") + F.col("m.last") + length).alias("end"))
    at_once = rows.where(F.size("starts") > 0).groupBy("text_id").agg(F.first("starts").alias("starts"), F.first("ends").alias("ends"))
    at_once = at_once.select("text_id", F.explode(F.arrays_zip("starts", "ends")).alias("s"))
    spans = spans.union(at_once.select("text_id", F.col("s.starts").alias("start"), F.col("s.ends").alias("end")))
    merged = spans.groupBy("text_id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))

    def joined(found: pa.Array) -> list[list[dict]]:
        out = []
        for spans in found.to_pylist():
            kept: list[dict] = []
            for span in spans:
                if kept and span["start"] <= kept[-1]["end"]:
                    kept[-1]["end"] = max(kept[-1]["end"], span["end"])
                else:
                    kept.append(dict(span))
            out.append(kept)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("spans")
            yield pa.RecordBatch.from_arrays(
                [batch.column("text_id"), pa.array(joined(spans), spans.type)], ["text_id", "spans"]
            )

    merged = merged.mapInArrow(run, merged.schema)
    return rows.select("doc_id", "text_id", "n_bytes", "sha256"), scratch.save(merged, "spans")[0]


def cut_texts(docs: DataFrame, rows: DataFrame, spans: DataFrame, scratch: Scratch) -> DataFrame:
    """``(text_id, kept)``: what is left, as bytes, of each distinct text that has spans.

    ``rows`` and ``spans`` as of ``repeated_spans``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for data, cuts in zip(batch.column("data").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                edges = [0, *(x for span in cuts for x in (span["start"], span["end"])), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays([batch.column("text_id"), pa.array(kept, pa.binary())], ["text_id", "kept"])

    holders = rows.groupBy("text_id").agg(F.min(_holder()).alias("holder"))
    wanted = spans.join(holders, "text_id").select("text_id", "holder", "spans")
    wanted, _ = scratch.save(wanted, "cuts")
    return _held_texts(docs, wanted, scratch).mapInArrow(run, "text_id binary, kept binary")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scratch = Scratch(spark)
    rows, spans = repeated_spans(docs, scratch)
    digests = cut_texts(docs, rows, spans, scratch).select("text_id", F.sha2("kept", 256).alias("kept_sha256"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    found = spans.select("text_id", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"))
    found = found.join(digests, "text_id")
    return rows.join(found, "text_id", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
    )
