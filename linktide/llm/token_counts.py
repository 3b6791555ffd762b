"""Token counts per section, from one encoding of the whole document."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linktide.llm.common import table, text_blocks

OUTSIDE = -1

_SCHEMA = (
    "doc_id long, section long, name string, start long, end long, n_tokens long, n_crossing long"
)
SECTIONS = "array<struct<name:string,start:long,end:long>>"


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@cache
def _encoding(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoding of a rank file, and the number of bytes of each id."""
    import public_tokenizers

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for piece, rank in ranks.items():
        sizes[rank] = len(piece)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return own, sizes


def token_spans(raw: bytes, path: str) -> tuple[np.ndarray, np.ndarray]:
    """``(starts, ends)`` of a text's tokens in code points.

    A token of byte-level BPE can hold a part of a character; it spans every character
    of which it has a byte, so neighbours can overlap in one.
    """
    encoding, sizes = _encoding(path)
    ids = np.array(encoding.encode_ordinary(raw.decode()), np.int64)
    ends = np.cumsum(sizes[ids])
    starts = ends - sizes[ids]
    data = np.frombuffer(raw, np.uint8)
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    return character[starts], character[ends - 1] + 1


def line_sections(raw: bytes) -> list[tuple[str | None, int, int]]:
    """The lines, each with its line end; the last one may be without."""
    text = raw.decode()
    ends = np.cumsum([len(line) + 1 for line in text.split("\n")]).tolist()
    ends[-1] = len(text)
    found = list(zip([None] * len(ends), [0, *ends[:-1]], ends, strict=True))
    return found[:-1] if len(found) > 1 and found[-1][1] == found[-1][2] else found


def attributed(
    starts: np.ndarray, ends: np.ndarray, sections: list[tuple[str | None, int, int]]
) -> tuple[np.ndarray, np.ndarray, int]:
    """``(tokens per section, crossing tokens per section, tokens outside)``.

    The interval join is a merge of two ascending lists. The rule: a token is of the
    section that holds most of its characters, of the first one if several hold as many.
    A token that reaches over its section's bounds is a crossing one.
    """
    if not sections:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), len(starts)
    low = np.array([s[1] for s in sections], np.int64)
    high = np.array([s[2] for s in sections], np.int64)
    # The sections that a token reaches into: those from ``first`` up to ``last``.
    first = np.searchsorted(high, starts, "right")
    last = np.searchsorted(low, ends, "left")
    of = np.where(last > first, first, -1)
    for t in np.flatnonzero(last - first > 1):
        k = np.arange(first[t], last[t])
        shared = np.minimum(high[k], ends[t]) - np.maximum(low[k], starts[t])
        of[t] = k[int(np.argmax(shared))]
    inside = of >= 0
    crossing = inside & ((starts < low[of]) | (ends > high[of]))
    count = np.bincount(of[inside], minlength=len(sections))
    return count, np.bincount(of[crossing], minlength=len(sections)), int((~inside).sum())


def _checked(sections: list[dict] | None) -> list[tuple[str | None, int, int]]:
    found = sorted(((s["name"], s["start"], s["end"]) for s in sections or [] if s and s["start"] is not None and s["end"] is not None), key=lambda s: s[1:])
    found = [s for s in found if s[1] < s[2]]
    for before, after in zip(found, found[1:], strict=False):
        if after[1] < before[2]:
            raise ValueError(f"sections overlap: {before} and {after}")
    return found


def count_tokens(docs: DataFrame, tokenizer: str | None = None, sections: Column | None = None) -> DataFrame:
    """``(doc_id, section, name, start, end, n_tokens, n_crossing)``, one row per section.

    Every text is encoded once, as a whole: a section's tokens are those of the text that
    ``attributed`` gives to it, so the counts of a document add up to its tokens.
    ``sections`` is an array of (name, start, end) in code points, for instance fields
    that were joined to one text; they must not overlap, and tokens outside of all of
    them are a row of their own (section -1). Without it the sections are the lines.

    A null or empty text has one empty section and no tokens. Null, empty or reversed
    sections are left out. Every row of ``docs`` gives its own rows; other columns are
    ignored. No shuffle.
    """
    path = tokenizer or byte_bpe_path()
    given = sections is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_blocks(batches, "text", 1 << 20):
            out: list[list] = [[] for _ in range(7)]
            doc_ids = rows.column("doc_id").to_pylist()
            parts = rows.column("sections").to_pylist() if given else [None] * len(doc_ids)
            for doc_id, a, b, own in zip(doc_ids, offsets[:-1], offsets[1:], parts, strict=True):
                raw = data[a:b].tobytes()
                starts, ends = token_spans(raw, path)
                cut = _checked(own) if given else line_sections(raw)
                n, crossing, outside = attributed(starts, ends, cut)
                for k, (name, low, high) in enumerate(cut):
                    for column, value in zip(out, (doc_id, k, name, low, high, n[k], crossing[k]), strict=True):
                        column.append(value)
                if outside or not cut:
                    for column, value in zip(out, (doc_id, OUTSIDE, None, None, None, outside, 0), strict=True):
                        column.append(value)
            types = [pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types, strict=True)],
                ["doc_id", "section", "name", "start", "end", "n_tokens", "n_crossing"],
            )

    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text")]
    if given:
        columns.append(sections.cast(SECTIONS).alias("sections"))
    return docs.select(*columns).mapInArrow(run, _SCHEMA)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents")).drop("name")
