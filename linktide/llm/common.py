"""Shared pieces: tables, text blocks inside tasks, hashes of words."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of all word rules here: [\x20\x09-\x0D].
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
WORD = r"[^\x20\x09-\x0D]+"
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Text handled at once inside a task; a longer single text is one block of its own.
BLOCK_BYTES = 2 << 20
# Bytes hashed at once; a longer single span is hashed by itself.
HASHED_BYTES = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def plain_names(docs: DataFrame) -> DataFrame:
    """``docs`` under names that ``mapInArrow`` can resolve; ``toDF`` gives the old ones back."""
    taken = set(docs.columns)
    names = []
    for k, name in enumerate(docs.columns):
        if "." in name or "`" in name:
            name = f"column_{k}"
            while name in taken:
                name += "_"
        names.append(name)
    return docs.toDF(*names)


def text_blocks(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """``(rows, data, offsets)``: row ``i``'s UTF-8 is ``data[offsets[i]:offsets[i + 1]]``.

    Null texts are empty. Blocks hold whole texts of about ``limit`` bytes together. Before
    the first block and after the last one, what earlier work has freed goes back to the
    system: workers live on, and would hold the most that any stage has needed.
    """
    release_memory()
    yield from _text_blocks(batches, column, limit)
    release_memory()


def _text_blocks(
    batches: Iterator[pa.RecordBatch], column: str, limit: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        texts = batch.column(column).cast(pa.large_binary()).fill_null(b"")
        if not len(texts):
            continue
        _, at, values = texts.buffers()
        at = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        values = np.frombuffer(values, np.uint8) if values else np.zeros(0, np.uint8)
        first = 0
        while first < len(texts):
            last = int(np.searchsorted(at, at[first] + limit, "right")) - 1
            last = min(max(last, first + 1), len(texts))
            data = values[at[first] : at[last]]
            yield batch.slice(first, last - first), data, at[first : last + 1] - at[first]
            first = last


def release_memory() -> None:
    """Give freed memory back to the system, where the allocators can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd base and of its inverse."""
    base = 0x9E3779B97F4A7C15
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    np.multiply.accumulate(up, out=up)
    np.multiply.accumulate(down, out=down)
    return up, down


_UP, _DOWN = _powers(HASHED_BYTES + 1)
_BYTE_VALUES = np.random.default_rng(7).integers(1 << 63, (1 << 64) - 1, 256, np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Bits of 64-bit values spread over the whole word (one to one)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[start:end]``, whatever stands around; both ``starts`` and
    ``ends`` ascend. Spans are hashed in parts of the data, so memory does not grow with it.
    """
    found = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        low = int(starts[a])
        b = max(a + 1, int(np.searchsorted(ends, low + HASHED_BYTES, "right")))
        part = data[low : int(ends[b - 1])]
        up, down = (_UP, _DOWN) if len(part) <= HASHED_BYTES else _powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[part] * up[: len(part)], out=sums[1:])
        begin, end = starts[a:b] - low, ends[a:b] - low
        h = (sums[end] - sums[begin]) * down[begin]
        found[a:b] = mixed(h + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        a = b
    return found


def word_spans(
    data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, first)`` of the words; row ``i`` has ``first[i]:first[i + 1]``."""
    outside = np.ones(len(data) + 1, bool)
    outside[:-1] = breaks[data]
    begins = ~outside[:-1]
    begins[1:] &= outside[:-2]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    begins[inner] |= ~outside[inner]
    ends = ~outside[:-1] & outside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    ends[last] |= ~outside[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


_ORDER = np.random.default_rng(11).integers(1, 1 << 62, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """Each row's sorted distinct hashes of ``words`` consecutive lower-cased words.

    A text of fewer words, but not none, is one shingle.
    """
    if words > len(_ORDER):
        raise ValueError(f"shingles of at most {len(_ORDER)} words")
    starts, ends, first = word_spans(data, offsets)
    h = span_hashes(LOWER[data], starts, ends)
    n = max(0, len(h) - words + 1)
    windows = np.full(n, words, np.uint64)
    for k in range(words):
        windows += h[k : k + n] * _ORDER[k]
    windows = mixed(windows)
    sets = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= words:
            sets.append(np.unique(windows[a : b - words + 1]))
        elif b > a:
            short = h[a:b] * _ORDER[: b - a]
            sets.append(mixed(short.sum(keepdims=True) + np.uint64(b - a)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
