"""Token ids as directly addressable codes: a file format with random access.

A file holds whole documents. Level 0 has the low 8 bits of every id; a bitmap says
which ids go on, level 1 has their next 8 bits in the same order, and so on up to 4
levels. A rank directory (ones before every block of 512 bits) turns an id's place on
one level into its place on the next, so any id is read without decoding others. All
numbers are little-endian.

    magic        8 bytes  "LTDACS01"
    n_documents  u64
    n_ids        u64
    n_levels     u64
    levels       n_levels x (count, chunks at, bitmap at, ranks at), u64 each; the last
                 level has no bitmap and no ranks (both 0)
    doc_ids      n_documents x i64
    has_doc_id   n_documents x u8, padded to a multiple of 8 (0: the doc_id is null)
    starts       (n_documents + 1) x u64: a document's first id in this file
    per level    chunks, bitmap (padded to whole blocks), ranks, each padded to 8 bytes
"""

from __future__ import annotations

from collections.abc import Iterator
from io import BytesIO
from typing import BinaryIO

import numpy as np

MAGIC = b"LTDACS01"
CHUNK_BITS = 8
BLOCK_BITS = 512
# Ids that are coded at once.
PIECE_IDS = 1 << 20


def _padded(part: bytes) -> bytes:
    return part + bytes(-len(part) % 8)


def _pieces(documents: list[np.ndarray]) -> Iterator[np.ndarray]:
    """The ids of all documents, about ``PIECE_IDS`` at a time."""
    held, size = [], 0
    for ids in documents:
        for k in range(0, len(ids), PIECE_IDS):
            held.append(ids[k : k + PIECE_IDS])
            size += len(held[-1])
            if size >= PIECE_IDS:
                yield np.concatenate(held).astype(np.uint32)
                held, size = [], 0
    if held:
        yield np.concatenate(held).astype(np.uint32)


def _of_level(ids: np.ndarray, level: int) -> np.ndarray:
    """Those of the ids that have chunks on this level, without their lower chunks."""
    shifted = ids >> np.uint32(CHUNK_BITS * level)
    return shifted[shifted > 0] if level else shifted


def _flags(documents: list[np.ndarray], level: int) -> bytes:
    """The bitmap of a level, padded to whole blocks."""
    parts, rest = [], np.zeros(0, bool)
    for ids in _pieces(documents):
        flags = np.concatenate([rest, _of_level(ids, level) >> np.uint32(CHUNK_BITS) > 0])
        whole = len(flags) - len(flags) % 8
        parts.append(np.packbits(flags[:whole], bitorder="little").tobytes())
        rest = flags[whole:]
    parts.append(np.packbits(rest, bitorder="little").tobytes())
    bitmap = b"".join(parts)
    return bitmap + bytes(-len(bitmap) % (BLOCK_BITS // 8))


def write_pack(out: BinaryIO, doc_ids: list[int | None], documents: list[np.ndarray]) -> None:
    """Write the file of these documents' ids (unsigned 32-bit), in the order given.

    Level by level and piece by piece: besides the documents themselves, only a bitmap and
    a piece are held.
    """
    sizes = [len(d) for d in documents]
    counts = [sum(sizes)]
    for level in range(1, 4):
        above = sum(int((d >> np.uint32(CHUNK_BITS * level) > 0).sum()) for d in documents)
        if not above:
            break
        counts.append(above)
    starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype("<u8")
    index = [
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        _padded(np.array([d is not None for d in doc_ids], np.uint8).tobytes()),
        starts.tobytes(),
    ]
    at = 32 + 32 * len(counts) + sum(map(len, index))
    heads = []
    for level, count in enumerate(counts):
        blocks = -(-count // BLOCK_BITS) if level + 1 < len(counts) else 0
        bitmap = at + count + -count % 8
        ranks = bitmap + blocks * (BLOCK_BITS // 8)
        heads.append(np.array([count, at, bitmap if blocks else 0, ranks if blocks else 0], "<u8").tobytes())
        at = ranks + 8 * blocks
    numbers = np.array([len(doc_ids), counts[0], len(counts)], "<u8").tobytes()
    out.write(b"".join([MAGIC, numbers, *heads, *index]))
    for level, count in enumerate(counts):
        for ids in _pieces(documents):
            out.write((_of_level(ids, level) & np.uint32((1 << CHUNK_BITS) - 1)).astype(np.uint8).tobytes())
        out.write(bytes(-count % 8))
        if level + 1 < len(counts):
            bitmap = _flags(documents, level)
            out.write(bitmap)
            ones = np.bitwise_count(np.frombuffer(bitmap, "<u8")).reshape(-1, BLOCK_BITS // 64).sum(axis=1)
            out.write(np.concatenate([[0], np.cumsum(ones)])[:-1].astype("<u8").tobytes())


def pack(doc_ids: list[int | None], documents: list[np.ndarray]) -> bytes:
    """The bytes of ``write_pack``."""
    out = BytesIO()
    write_pack(out, doc_ids, documents)
    return out.getvalue()


class TokenFile:
    """Random access to a file of ``pack``: reads only the bytes that a call needs."""

    def __init__(self, source: BinaryIO):
        self._source = source
        head = self._read(0, 32)
        if head[:8] != MAGIC:
            raise ValueError("not a token file")
        self.n_documents, self.n_ids, n_levels = (int(x) for x in np.frombuffer(head[8:], "<u8"))
        self._levels = np.frombuffer(self._read(32, 32 * n_levels), "<u8").reshape(-1, 4).tolist()
        self._index = 32 + 32 * n_levels

    def _read(self, at: int, size: int) -> bytes:
        self._source.seek(at)
        return self._source.read(size)

    def index(self) -> tuple[list[int | None], np.ndarray]:
        """The documents' ids and their starts, the end of the last one included."""
        n = self.n_documents
        ids = np.frombuffer(self._read(self._index, 8 * n), "<i8").tolist()
        known = self._read(self._index + 8 * n, n)
        starts = self._read(self._index + 8 * n + n + -n % 8, 8 * n + 8)
        pairs = zip(ids, known, strict=True)
        return [i if k else None for i, k in pairs], np.frombuffer(starts, "<u8").astype(np.int64)

    def document(self, k: int) -> np.ndarray:
        """The ids of the file's document number ``k``."""
        at = self._index + 8 * self.n_documents + self.n_documents + -self.n_documents % 8 + 8 * k
        first, last = (int(x) for x in np.frombuffer(self._read(at, 16), "<u8"))
        return self.ids(first, last)

    def id(self, i: int) -> int:
        return int(self.ids(i, i + 1)[0])

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids ``first`` to ``last`` (exclusive), whatever documents they are of."""
        if not 0 <= first <= last <= self.n_ids:
            raise IndexError(f"{first}:{last} of {self.n_ids} ids")
        found = np.zeros(last - first, np.uint32)
        place = np.arange(last - first)
        for level, (_, chunks, bitmap, ranks) in enumerate(self._levels):
            if first == last:
                break
            part = np.frombuffer(self._read(chunks + first, last - first), np.uint8)
            found[place] |= part.astype(np.uint32) << np.uint32(CHUNK_BITS * level)
            if not bitmap:
                break
            block, end = first // BLOCK_BITS, -(-last // BLOCK_BITS)
            stored = self._read(bitmap + block * BLOCK_BITS // 8, (end - block) * BLOCK_BITS // 8)
            bits = np.unpackbits(np.frombuffer(stored, np.uint8), bitorder="little")
            begin = first - block * BLOCK_BITS
            before = int(np.frombuffer(self._read(ranks + 8 * block, 8), "<u8")[0])
            more = bits[begin : begin + last - first].astype(bool)
            place = place[more]
            first = before + int(bits[:begin].sum())
            last = first + int(more.sum())
        return found
