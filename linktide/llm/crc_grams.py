"""CRC-32 of every word n-gram of a text, from one scan that stores running CRCs.

The words of a text, joined by one space, are scanned once. With ``R(p)`` the CRC of the
first ``p`` bytes, the CRC of the bytes from ``a`` to ``b`` is ``R(b) ^ shift(R(a), b - a)``,
where ``shift`` multiplies by ``x ** (8 n)`` in GF(2), as ``n`` zero bytes would: what stands
before ``a`` cancels out. No n-gram is spelled out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import accumulate
from zlib import crc32

import numpy as np

from linktide.llm.common import word_spans

# Fixed value: the polynomial of CRC-32, lowest power first.
POLYNOMIAL = 0xEDB88320
_TABLED = 255  # lengths up to this have a table of their own

# A-Z become lower case; bytes that are no letter, digit or part of a non-ASCII character
# stand between words.
FOLD = np.full(256, 0x20, np.uint8)
FOLD[0x30:0x3A] = np.arange(0x30, 0x3A)
FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
FOLD[0x80:] = np.arange(0x80, 0x100)


def _byte_table() -> np.ndarray:
    rest = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        rest = np.where(rest & 1, (rest >> 1) ^ np.uint32(POLYNOMIAL), rest >> 1).astype(np.uint32)
    return rest


_BYTE = _byte_table()


def _zero_byte(c: np.ndarray) -> np.ndarray:
    return _BYTE[c & 0xFF] ^ (c >> np.uint32(8))


def _after_space(c: np.ndarray) -> np.ndarray:
    """Running CRCs after one more byte, a space."""
    c = ~c
    return ~(_BYTE[(c ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (c >> np.uint32(8)))


@cache
def _shifts() -> np.ndarray:
    """``[n, j, v]``: the value ``v`` in byte ``j`` of a CRC, shifted by ``n`` bytes."""
    v = np.arange(256, dtype=np.uint32)
    tables = [np.stack([v << np.uint32(8 * j) for j in range(4)])]
    for _ in range(_TABLED):
        tables.append(_zero_byte(tables[-1]))
    return np.stack(tables)


@cache
def _doubled(k: int) -> np.ndarray:
    """The table for a shift by ``2 ** k`` bytes."""
    if 1 << k <= _TABLED:
        return _shifts()[1 << k]
    half = _doubled(k - 1)
    return _shifted(half, half.ravel()).reshape(4, 256)


def _shifted(table: np.ndarray, c: np.ndarray) -> np.ndarray:
    found = table[0][c & np.uint32(0xFF)]
    for j in range(1, 4):
        found = found ^ table[j][(c >> np.uint32(8 * j)) & np.uint32(0xFF)]
    return found


def shift(c: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRCs multiplied by ``x ** (8 n)``, each by its own ``n``."""
    tables = _shifts().reshape(-1)
    base = np.minimum(n, _TABLED) * 1024
    found = tables[base + (c & np.uint32(0xFF))]
    for j in range(1, 4):
        found ^= tables[base + 256 * j + ((c >> np.uint32(8 * j)) & np.uint32(0xFF))]
    long = np.flatnonzero(n > _TABLED)
    if len(long):
        rest, k, part = n[long] - _TABLED, 0, found[long]
        while rest.any():
            odd = (rest & 1).astype(bool)
            part[odd] = _shifted(_doubled(k), part[odd])
            rest, k = rest >> 1, k + 1
        found[long] = part
    return found


class RunningCrcs:
    """The running CRCs of a block of texts at the edges of their words.

    Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z is lower-cased; text
    ``i`` has the words ``first[i]:first[i + 1]``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        folded = FOLD[data]
        starts, ends, self.first = word_spans(folded, offsets)
        sizes = ends - starts
        # Every word behind one space: the separator-normalised texts, end to end.
        self.ends = np.cumsum(sizes + 1)
        self.starts = self.ends - sizes
        joined = np.full(self.ends[-1] if len(sizes) else 0, 0x20, np.uint8)
        letters = folded[folded != 0x20]
        joined[np.arange(len(letters)) + np.repeat(np.arange(1, len(sizes) + 1), sizes)] = letters
        self.after = np.fromiter(self._scan(joined.tobytes()), np.uint32, len(sizes))
        self.before = np.zeros(len(sizes), np.uint32)
        if len(sizes):
            self.before[1:] = _after_space(self.after[:-1])
        self.before[self.first[:-1][self.first[:-1] < len(sizes)]] = 0
        self.last = np.repeat(self.first[1:], np.diff(self.first))

    def _scan(self, joined: bytes) -> Iterator[int]:
        view, ends, starts = memoryview(joined), self.ends.tolist(), self.starts.tolist()

        def step(running: int, part: memoryview) -> int:
            return crc32(part, running)

        for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist(), strict=True):
            if a < b:
                parts = [view[starts[a] : ends[a]]]
                parts += [view[ends[k - 1] : ends[k]] for k in range(a + 1, b)]
                yield from list(accumulate(parts, step, initial=0))[1:]

    def grams(self, words: int) -> tuple[np.ndarray, np.ndarray]:
        """``(k, crc)``: the first word and the CRC of every run of ``words`` words."""
        k = np.arange(len(self.after))
        k = k[k + words <= self.last]
        end = k + words - 1
        return k, self.after[end] ^ shift(self.before[k], self.ends[end] - self.starts[k])


def sql_crc32(text: str) -> str:
    """DuckDB SQL for the CRC-32 of a text expression's UTF-8, four bits at a time."""
    rests = range(16)
    for _ in range(4):
        rests = [(r >> 1) ^ POLYNOMIAL if r & 1 else r >> 1 for r in rests]
    table = "[" + ", ".join(map(str, rests)) + "]"
    nibbles = f"string_split(regexp_replace(hex(encode({text})), '(.)(.)', '\\2\\1', 'g'), '')"
    return (
        f"xor(list_reduce([4294967295] || [strpos('123456789ABCDEF', h) for h in {nibbles}], "
        f"lambda c, x: xor(c >> 4, {table}[1 + (xor(c, x) & 15)])), 4294967295)"
    )
