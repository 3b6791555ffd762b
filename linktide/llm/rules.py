"""Quality rules: a threshold table compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linktide.llm.common import WORD, table, text_of
from linktide.llm.spans import let

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# The most frequent words of the languages that the rules are for: English, German, French
# and Spanish. Texts in others have next to none of them, and fail.
STOP_WORDS = (
    "the of and to in a is that it for was with as on be "
    "der die das und zu den von mit ist im ein nicht sich auf "
    "le la les de des et en un une que qui dans est pour "
    "el los las y del se por con una al lo su"
).split()


@dataclass(frozen=True)
class Rule:
    """A document passes if ``least <= metric <= most``; ``None`` is no bound."""

    metric: str
    least: float | None = None
    most: float | None = None

    def passed(self) -> Column:
        value = F.col(self.metric)
        bounds = F.lit(True)
        if self.least is not None:
            bounds &= value >= self.least
        if self.most is not None:
            bounds &= value <= self.most
        return bounds


# Metrics: see ``_metrics``. Ratios of a text without words are 0.
RULES = (
    Rule("word_length", 2.0, 12.0),
    Rule("symbol_ratio", most=0.25),
    Rule("stop_ratio", least=0.05),
    Rule("dup_line_ratio", most=0.5),
    Rule("word_share", least=0.6),
)


def _repeat_words(words: Column) -> Column:
    """Words inside ``WINDOW``-word windows that occur more than once.

    Windows are first told apart by hash. Only a text in which hashes repeat has its
    windows spelled out and sorted, each next to its equals.
    """
    places = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))

    def spelled(w: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)),
            lambda i: F.struct(F.concat_ws(" ", F.slice(w, i, WINDOW)).alias("text"), i.alias("at")),
        )
        return let(F.sort_array(windows), _covered)

    def _covered(s: Column) -> Column:
        same = F.filter(
            s,
            lambda x, i: ((i > 0) & (F.get(s, i - 1)["text"] == x["text"]))
            | ((i < F.size(s) - 1) & (F.get(s, i + 1)["text"] == x["text"])),
        )
        inside = F.flatten(F.transform(same, lambda x: F.sequence(x["at"], x["at"] + (WINDOW - 1))))
        return F.size(F.array_distinct(inside))

    hashes = F.transform(places, lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    repeated = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(F.size(words) < WINDOW, 0).when(repeated, spelled(words)).otherwise(0)


def document_metrics(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)`` and the
    ratios that rules use, from whole texts in one scan without a shuffle. A null text
    is empty."""
    text, words = F.col("text"), F.col("words")
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.length(F.translate(line, SPACES, "")) > 0)
    counted = docs.select("doc_id", text_of().alias("text")).select(
        "doc_id", "text", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words")
    )
    counted = counted.select(
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("kinds"))).alias("lines"),
        let(words, _repeat_words).cast("long").alias("n_repeat_words"),
        F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).alias("n_stops"),
        F.length(text).alias("n_chars"),
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(0.0)

    dup_lines = (F.col("lines.n") - F.col("lines.kinds")).cast("long")
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", dup_lines.alias("n_dup_lines"), "n_repeat_words",
        ratio(F.col("n_stops"), F.col("n_words")).alias("stop_ratio"),
        ratio(F.col("word_chars"), F.col("n_words")).alias("word_length"),
        ratio(F.col("n_symbols"), F.col("n_words")).alias("symbol_ratio"),
        ratio(dup_lines, F.col("lines.n")).alias("dup_line_ratio"),
        ratio(F.col("word_chars"), F.col("n_chars")).alias("word_share"),
    )


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The metrics of ``document_metrics`` with ``base_failed``, ``failed`` and ``kept``.

    ``base_failed``: fewer than 10 words, or more than a fifth of the words in repeated
    windows. ``failed`` names the metrics of the rules not passed; a document is kept if
    neither says no. Every row of ``docs`` gives a row; null and empty texts fail the
    base. Other columns are ignored.
    """
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    names = [F.when(~rule.passed(), F.lit(rule.metric)) for rule in rules]
    failed = F.filter(F.array(*names), lambda x: x.isNotNull()) if names else F.array().cast("array<string>")
    rows = document_metrics(docs).withColumn("base_failed", base).withColumn("failed", failed)
    return rows.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)
OP3_SQL = rf"""
with split as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] as lines
  from documents),
windows as (
  select doc_id, i, count(*) over (partition by doc_id, array_to_string(w[i:i + 4], ' ')) as n
  from split, unnest(range(1, len(w) - 3)) as r(i)),
repeated as (
  select doc_id, count(distinct p) as n_repeat_words
  from windows, unnest(range(i, i + 5)) as r(p) where n > 1 group by doc_id),
counted as (
  select doc_id, len(w) as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
    len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words, length(text) as n_chars,
    len([x for x in w if list_contains([{_STOPS}], lower(x))]) as n_stops
  from split left join repeated using (doc_id)),
judged as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from counted)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
  cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
  cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
  not base_failed and word_chars between 2 * n_words and 12 * n_words and n_symbols <= 0.25 * n_words
    and n_stops / n_words >= 0.05 and n_dup_lines <= 0.5 * n_lines and word_chars >= 0.6 * n_chars as kept
from judged
"""
