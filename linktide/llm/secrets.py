"""Secret scan with multipart credential linking, from built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linktide.llm.common import table, text_of
from linktide.llm.spans import empty, in_order, joined, row_key, spans
from linktide.scratch import Scratch

KINDS = ("assign", "access", "hex", "ident", "key", "endpoint")
SCOPE = 300

_ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]++)"
)
_ACCESS = r"AKIA[A-Z0-9]++"
_HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"

# Weak parts: each alone is often harmless.
_IDENT = (
    r"(?<![A-Za-z0-9])(?:(?:ASIA|AIDA|AROA)[A-Z0-9]{12,}+"
    r"|(?i:access_?key_?id|client_?id|account_?id|user_?name|login)[\"']?\x20{0,4}[:=]\x20{0,4}[\"']?[A-Za-z0-9@._-]{4,}+)"
)
# '=' may stand before a key (name=value, ?sig=value); after one it is padding only.
_KEY = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}+={0,2}(?![A-Za-z0-9+/=_-])"
_ENDPOINT = r"(?<![A-Za-z0-9])(?:https?|ftp|jdbc|postgres|postgresql|mysql|mongodb|redis|amqp|s3)://[^\s\"'<>]{4,}+"


def _all_there(value: Column) -> Column:
    return value.rlike("[a-z]") & value.rlike("[A-Z]") & value.rlike("[0-9]")


def base_spans(text: Column) -> list[Column]:
    """The matches that are reported by themselves, one column per kind."""
    return [
        F.when(text.rlike("[:=]"), spans(text, "assign", _ASSIGN, _long_value)).otherwise(empty()),
        F.when(F.contains(text, F.lit("AKIA")), spans(text, "access", _ACCESS, lambda v: F.length(v) >= 16)).otherwise(empty()),
        F.when(text.rlike("[0-9a-f]{32}"), spans(text, "hex", _HEX)).otherwise(empty()),
    ]


def _long_value(match: Column) -> Column:
    return F.length(F.regexp_extract(match, f"^{_ASSIGN}", 1)) >= 8


def _weak_spans(text: Column) -> Column:
    digits = text.rlike("[0-9]")
    return F.concat(
        F.when(text.rlike("ASIA|AIDA|AROA|[:=]"), spans(text, "ident", _IDENT)).otherwise(empty()),
        F.when(digits, spans(text, "key", _KEY, _all_there)).otherwise(empty()),
        F.when(F.contains(text, F.lit("://")), spans(text, "endpoint", _ENDPOINT)).otherwise(empty()),
    )


def link_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak ones of ``parts(row, kind, start, end, value, weak)`` that have their complement.

    A part's role is identifier (ident, access), secret (assign, hex, key) or endpoint. Two
    parts of a text are in one scope if at most ``scope`` code points lie between them. An
    identifier needs a secret in scope, a secret an identifier or an endpoint, and an
    endpoint both of the others. The interval join is by bins of ``scope``: parts are
    summed up per bin and role (least start, greatest end), and a weak part looks at the
    bins around its own, so no pairs are formed however many parts a text has.
    """
    role = (
        F.when(F.col("kind").isin("ident", "access"), "identifier")
        .when(F.col("kind") == "endpoint", "endpoint")
        .otherwise("secret")
    )
    parts = parts.withColumn("role", role)
    first, last = F.floor(F.col("start") / scope), F.floor(F.col("end") / scope)
    posted = parts.select("row", "role", "start", "end", F.explode(F.sequence(first, last)).alias("bin"))
    bins = posted.groupBy("row", "bin", "role").agg(
        F.min("start").alias("low"), F.max("end").alias("high")
    ).groupBy("row", "bin").agg(F.collect_list(F.struct("role", "low", "high")).alias("others"))  # three roles at most
    probes = parts.where("weak").withColumn("bin", F.explode(F.sequence(first - 1, last + 1)))
    near = F.transform(
        F.filter(
            "others",
            lambda o: (o["role"] != F.col("role"))
            & (((o["low"] <= F.col("end") + scope) & (o["high"] >= F.col("start") - scope))),
        ),
        lambda o: o["role"],
    )
    seen = probes.join(bins, ["row", "bin"]).groupBy("row", "kind", "start", "end", "value", "role").agg(
        F.array_distinct(F.flatten(F.collect_list(near))).alias("near")
    )
    has = {name: F.array_contains("near", name) for name in ("identifier", "secret", "endpoint")}
    linked = (
        F.when(F.col("role") == "identifier", has["secret"])
        .when(F.col("role") == "secret", has["identifier"] | has["endpoint"])
        .otherwise(has["identifier"] & has["secret"])
    )
    return seen.where(linked).select("row", "kind", "start", "end", "value")


def scan_secrets(docs: DataFrame, scratch: Scratch, scope: int = SCOPE) -> DataFrame:
    """``(doc_id, assign, access, hex, found)``: spans with kind, start, end and value.

    ``found`` has the three base kinds and the weak parts (ident, key, endpoint) that
    ``link_parts`` reports, by start and then kind. Offsets are code points, the end is
    exclusive. A null text is empty, an empty text has no spans, every row gives a row;
    equal rows have equal spans. Only found spans are moved, never texts.
    """
    text = F.col("text")
    assign, access, hexes = base_spans(text)
    rows = docs.select("doc_id", text_of().alias("text")).select(
        "doc_id", row_key().alias("row"), assign.alias("assign"), access.alias("access"),
        hexes.alias("hex"), _weak_spans(text).alias("weak"),
    )
    rows, _ = scratch.save(rows, "spans")
    base = F.concat("assign", "access", "hex")
    # A weak match inside of a base one is that one again.
    rest = F.filter(
        "weak", lambda w: ~F.exists(base, lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"]))
    )
    weak = rows.select("row", base.alias("base"), rest.alias("weak")).where(F.size("weak") > 0)
    parts = weak.select("row", F.explode("weak").alias("s"), F.lit(True).alias("weak")).union(
        weak.select("row", F.explode("base").alias("s"), F.lit(False).alias("weak"))
    )
    linked = link_parts(parts.select("row", "s.*", "weak").distinct(), scope)
    linked = linked.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end", "value")).alias("more"))
    found = F.concat(base, F.coalesce("more", empty()))
    return rows.join(linked, "row", "left").select(
        "doc_id", "assign", "access", "hex", in_order(found, KINDS, by_start=True).alias("found")
    )


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan_secrets(table(spark, sf_dir, "documents"), Scratch(spark))
    base = in_order(F.concat("assign", "access", "hex"), KINDS, by_start=True)
    return rows.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )
