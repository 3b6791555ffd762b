"""Benchmark decontamination with a suffix automaton of the test items."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from linktide.llm.automaton import ItemAutomaton
from linktide.llm.common import plain_names, table, text_blocks

WINDOW = 10
# Item words per automaton, which is broadcast: some 100 MB at most.
BLOCK_WORDS = 200_000

# A-Z become lower case; bytes that are no letter, digit or part of a non-ASCII character
# stand between words.
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x30:0x3A] = np.arange(0x30, 0x3A)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_WORD = re.compile(rb"[^ ]+")


def folded_words(text: str | None) -> list[bytes]:
    return _FOLD[np.frombuffer((text or "").encode(), np.uint8)].tobytes().split()


def _automata(items: DataFrame, window: int, block_words: int) -> Iterator[ItemAutomaton]:
    """One automaton per block of items; what is collected is bounded by the block."""
    rough = F.octet_length(F.coalesce(F.col("text"), F.lit(""))) / 4 + 1
    items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("key"), "text")
    total = items.agg(F.sum(rough)).first()[0] or 0
    blocks = max(1, -(-int(total) // block_words))
    block = F.pmod(F.xxhash64("key", "text"), F.lit(blocks))
    for k in range(blocks):
        rows = items.where(block == k).distinct().collect()
        yield ItemAutomaton([(r.key, folded_words(r.text)) for r in rows], window)


class MarkNames:
    """Names for the mark columns that ``docs`` does not have."""

    def __init__(self, docs: DataFrame):
        taken = {c.lower() for c in docs.columns}

        def free(name: str) -> str:
            while name in taken:
                name += "_"
            return name

        self.n_words, self.n_hit = free("n_words"), free("n_hit")
        self.spans, self.items = free("hit_spans"), free("hit_items")


def mark_contamination(
    docs: DataFrame, items: DataFrame, *, window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> tuple[DataFrame, MarkNames]:
    """``docs`` with its words, its hit words, their byte spans and the items they are of.

    Words are runs of ASCII letters (A-Z lower-cased), digits and non-ASCII characters. A
    window is ``window`` consecutive words of an item, or the whole of a shorter item; a
    word inside any occurrence of a window is hit. Adds ``n_words``, ``n_hit``,
    ``hit_spans`` (``[start, end)`` in bytes of the UTF-8 text, merged over neighbouring
    words) and ``hit_items`` (sorted as strings), under names that ``docs`` does not use
    (returned). Texts are whole and stay where they are: no shuffle.

    Null or empty texts have no words. Items that are null, empty or without words have
    no windows; repeated items count once per item_id; a null item_id reads as ''. Items
    above ``block_words`` words are dealt over several automata, each of which sees all
    documents.
    """
    spark = docs.sparkSession
    names = MarkNames(docs)
    marks = [
        StructField(names.n_words, LongType()), StructField(names.n_hit, LongType()),
        StructField(names.spans, ArrayType(ArrayType(LongType()))),
        StructField(names.items, ArrayType(StringType())),
    ]
    given, docs = docs.columns, plain_names(docs)
    schema = StructType([*docs.schema.fields, *marks])
    arrow = to_arrow_schema(schema)
    for k, automaton in enumerate(_automata(items, window, block_words)):
        shared = spark.sparkContext.broadcast(automaton)
        docs = docs.mapInArrow(_marker(shared, names, arrow, first=k == 0), schema)
    return docs.toDF(*given, *docs.columns[len(given) :]), names


def _marker(shared, names: MarkNames, arrow: pa.Schema, first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        number = automaton.vocabulary.get
        for rows, data, offsets in text_blocks(batches, "text"):
            folded = _FOLD[data].tobytes()
            marks: tuple[list, ...] = ([], [], [], [])
            before = repeat(([], [])) if first else zip(
                rows.column(names.spans).to_pylist(), rows.column(names.items).to_pylist(), strict=True
            )
            for (a, b), (old_spans, old_items) in zip(zip(offsets[:-1], offsets[1:], strict=True), before):
                text = folded[a:b]
                words = text.split()
                codes = np.fromiter(map(number, words, repeat(-1)), np.int64, len(words))
                spans, items = automaton.matches(codes)
                if spans or old_spans:
                    spans, hit = _byte_spans(text, spans, old_spans)
                else:
                    spans, hit = [], 0
                for column, value in zip(marks, (len(words), hit, spans, sorted(items | set(old_items))), strict=True):
                    column.append(value)
            kept = {name: rows.column(name) for name in rows.schema.names}
            made = dict(zip((names.n_words, names.n_hit, names.spans, names.items), marks, strict=True))
            kept |= {name: pa.array(values, arrow.field(name).type) for name, values in made.items()}
            yield pa.RecordBatch.from_arrays([kept[f.name].cast(f.type) for f in arrow], schema=arrow)

    return run


def _byte_spans(text: bytes, spans, old) -> tuple[list[list[int]], int]:
    at = [m.span() for m in _WORD.finditer(text)]
    found = [[at[i][0], at[j - 1][1]] for i, j in spans] + (old or [])
    merged: list[list[int]] = []
    for a, b in sorted(found):
        # Spans with no word between them are one.
        if merged and (a <= merged[-1][1] or not text[merged[-1][1] : a].strip()):
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    starts = np.array([a for a, _ in at])
    hit = sum(int(np.searchsorted(starts, b) - np.searchsorted(starts, a)) for a, b in merged)
    return merged, hit


def decontaminate(
    docs: DataFrame, items: DataFrame, *, window: int = WINDOW, max_hit_words: int = 0,
    max_coverage: float = 0.5,
) -> DataFrame:
    """``docs`` without test items, all its columns kept.

    Hit spans (see ``mark_contamination``) are cut out of a text with more than
    ``max_hit_words`` hit words; where they cover more than ``max_coverage`` of its words
    the document goes. Other rows are returned as they are, null and empty texts
    included; ``n_chars``, where there is such a column, follows a cut text.
    """
    marked, names = mark_contamination(docs, items, window=window)
    n_words, n_hit, spans = F.col(names.n_words), F.col(names.n_hit), F.col(names.spans)
    marked = marked.where(n_hit <= n_words * F.lit(float(max_coverage)))
    cut = n_hit > max_hit_words
    text = F.when(cut, _without(F.col("text"), spans)).otherwise(F.col("text"))
    marked = marked.withColumn("text", text)  # a step of its own, as n_chars reads it
    columns = {}
    if "n_chars" in docs.columns:
        n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(cut, n_chars).otherwise(F.col("n_chars"))
    return marked.select(*[columns.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def _without(text: Column, spans: Column) -> Column:
    """The text's bytes outside of the spans; a span begins and ends at whole characters."""
    data = F.encode(text, "UTF-8")
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s[1]))
    ends = F.concat(F.transform(spans, lambda s: s[0]), F.array(F.octet_length(data).cast("long")))
    pieces = F.transform(
        F.arrays_zip(starts.alias("a"), ends.alias("b")),
        lambda p: F.decode(F.substr(data, (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int")), "UTF-8"),
    )
    return F.array_join(pieces, "")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked, names = mark_contamination(docs, table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id", "n_words", "n_hit", F.size(names.items).cast("long").alias("n_items"),
        F.sha2(F.array_join(names.items, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP5_SQL = r"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
items as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
windows as (
  select distinct item_id, least(10, len(w)) as n,
    array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as win
  from items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as r(i) where len(w) > 0),
places as (
  select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as win
  from words, (select distinct n from windows) sizes, unnest(range(1, len(w) - n + 2)) as r(i)),
hits as (select doc_id, i, n, item_id from places join windows using (n, win)),
covered as (
  select doc_id, count(distinct p) as n_hit from hits, unnest(range(i, i + n)) as r(p) group by doc_id),
found as (
  select doc_id, count(distinct item_id) as n_items,
    array_to_string(list_sort(list(distinct cast(item_id as varchar))), ',') as ids from hits group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from words left join covered using (doc_id) left join found using (doc_id)
"""
