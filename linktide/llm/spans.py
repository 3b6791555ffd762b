"""Pattern matches with code point offsets, from built-in functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<kind:string,start:long,end:long,value:string>"
_STEP = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def empty(kind: str = SPAN) -> Column:
    return F.array().cast(f"array<{kind}>")


def matches(text: Column, pattern: str, body: Callable[..., Column]) -> Column:
    """``body(value, start, before)`` of the leftmost non-overlapping matches, in order.

    The text between matches (``before``) and the matches alternate, so a match starts
    at the summed length of what stands before it. Sums are taken per ``_STEP`` matches
    and then inside a step. The pattern must not match the empty string.
    """
    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"),
        F.split(text, pattern, -1).alias("gaps"),
    )

    def placed(m: Column) -> Column:
        values, gaps = m["values"], m["gaps"]
        sizes = F.zip_with(values, F.slice(gaps, F.lit(1), F.size(values)), lambda v, g: (F.length(v) + F.length(g)).cast("long"))
        return F.when(F.size(values) == 0, empty_like).otherwise(
            let(F.struct(values.alias("values"), gaps.alias("gaps"), sizes.alias("sizes")), stepped)
        )

    def total(sizes: Column, first: Column, count: Column) -> Column:
        return F.aggregate(F.slice(sizes, first, count), F.lit(0).cast("long"), lambda a, x: a + x)

    def stepped(m: Column) -> Column:
        steps = F.sequence(F.lit(0), F.floor((F.size(m["values"]) - 1) / _STEP).cast("int"))
        sums = F.transform(steps, lambda k: total(m["sizes"], F.lit(1), k * _STEP))
        return let(sums, lambda s: F.transform(m["values"], lambda v, i: at(m, s, v, i)))

    def at(m: Column, sums: Column, value: Column, i: Column) -> Column:
        step = F.floor(i / _STEP).cast("int")
        gap = m["gaps"][i]
        inner = total(m["sizes"], step * _STEP + 1, i - step * _STEP)
        return body(value, sums[step] + inner + F.length(gap), gap)

    one = body(F.lit(""), F.lit(0).cast("long"), F.lit(""))
    empty_like = F.slice(F.array(one), F.lit(1), F.lit(0))
    return let(found, placed)


def spans(text: Column, kind: str, pattern: str, keep: Callable[[Column], Column] | None = None) -> Column:
    """``array<struct<kind, start, end, value>>``; matches that ``keep`` refuses are dropped."""

    def span(value: Column, start: Column, _: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), start.alias("start"),
            (start + F.length(value)).alias("end"), value.alias("value"),
        )

    found = matches(text, pattern, span)
    return found if keep is None else F.filter(found, lambda s: keep(s["value"]))


def joined(found: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined in the order given."""
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def in_order(found: Column, kinds: tuple[str, ...], by_start: bool) -> Column:
    """The distinct spans by start and then kind, or by kind and then start."""
    names = F.array(*map(F.lit, kinds))

    def ranked(s: Column) -> Column:
        kind = F.array_position(names, s["kind"])
        order = [s["start"].alias("a"), kind.alias("b")] if by_start else [kind.alias("a"), s["start"].alias("b")]
        return F.struct(*order, s["end"].alias("c"), s.alias("span"))

    return F.transform(F.sort_array(F.array_distinct(F.transform(found, ranked))), lambda x: x["span"])


def row_key() -> Column:
    """A name for a row that equal rows share: its doc_id and the digest of its text."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return F.concat_ws(":", name, F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
