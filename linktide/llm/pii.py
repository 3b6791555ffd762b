"""Personal data by bootstrapped contextual extraction, from built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linktide.llm.common import table, text_of
from linktide.llm.spans import empty, in_order, joined, let, matches, row_key, spans
from linktide.scratch import Scratch

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
LEAST_SEEDS = 3
LEAST_CONFIDENCE = 0.5
# A shape alone, without a word around it, has to be surer.
SHAPE_CONFIDENCE = 0.6
# So many instances of a pattern that is not trusted speak against a value.
SURE_INSTANCES = 10
# Forms of patterns, from the most to the least special: two words before, one before and the
# shape of the value, the shape and one behind, one before, the shape alone, and the shape
# whatever the length of its numbers, unless it is one number.
FORMS = ("2", "1s", "sr", "1", "s", "c")
SHAPES = ("s", "c")

# A match begins where a run begins, or where the match before ended: the same matches as
# without that, but every run is read once. Possessive, as no part can give back.
_EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.|$)){4}$"

# What could be an identifier: a token with a digit or an at sign.
_TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
_TOKEN_TYPE = (
    "struct<kind:string,start:long,end:long,value:string,pair:string,last:string,right:string,glue:string,part:boolean>"
)
# The last word of a text, and the last but one. What is read is linear in the text.
_LAST = r"(?s)^.*(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++)[\x20\x09-\x0D]*+\z"
_SECOND = r"(?s)^.*(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++)[\x20\x09-\x0D]++[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+\z"
# The first word of what stands between two tokens.
_FIRST = r"^[\x20\x09-\x0D]++([^\x20\x09-\x0D]++)(?=[\x20\x09-\x0D])"
# Longer patterns are told apart by their digests.
_PATTERN_CHARS = 80

# Parts of one number: digits and the signs of a number, a blank or a sign between blanks apart.
# A part with as many digits as a whole local number has is the last one.
_PART = r"^[\"'(\[<+]*+[0-9][0-9()./-]*+(?<=[0-9)/-])\z"
_NEXT = r"^\(?[0-9][0-9()./-]*+[^\p{L}0-9@]*+\z"
_GLUE = r"^\x20(?:[./-]\x20)?\z"
_WHOLE_DIGITS = 7
# Signs in front of a value; an opening bracket belongs to it if the number goes on behind "(12)".
_SIGNS = r"^[^A-Za-z0-9+@]*?(?=\([0-9]++\)[^A-Za-z0-9]*+[0-9]|[A-Za-z0-9+@]|\z)"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(_digits(value))
    each = F.transform(
        F.sequence(F.lit(0), F.length(digits) - 1),
        lambda i: F.substr(digits, i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1),
    )
    total = F.aggregate(each, F.lit(0), lambda a, x: a + x - F.when(x > 9, 9).otherwise(0))
    return total % 10 == 0


def _classes(words: Column) -> Column:
    """Words as they stand in patterns; long ones by their digest."""
    words = F.regexp_replace(F.lower(words), "[0-9]", "0")
    return F.when(F.length(words) > _PATTERN_CHARS, F.sha2(words, 256)).otherwise(words)


def _shape(value: Column) -> Column:
    """Digits as 0, one by one, and runs of letters as one letter."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[0-9]", "0"), "[a-z]+", "a"), "[A-Z]+", "A")
    return F.when(F.length(shape) > _PATTERN_CHARS, F.sha2(shape, 256)).otherwise(shape)


def _forms() -> Column:
    """The patterns of a place with ``pair``, ``last``, ``right`` and ``value``, by ``FORMS``;
    null where a word that the form needs is not there."""
    shape, bar = _shape(F.col("value")), F.lit("|")
    forms = [
        F.col("pair"), F.concat("last", bar, shape), F.concat(shape, bar, F.col("right")), F.col("last"), shape,
        F.when(shape.rlike("[^0]"), F.regexp_replace(shape, "0+", "0")),
    ]
    return F.array(*[F.concat(F.lit(f"{name}:"), form) for name, form in zip(FORMS, forms, strict=True)])


def _tokens(text: Column) -> Column:
    """What could be an identifier, each with the words around it, lower-cased and with
    digits as 0: the ``pair`` of words before it, the ``last`` one of them, and the one to the
    ``right``; null where the text has none, and for the word behind the last token.

    A token is a whole word, so the words before it are those of the gap and, where the gap
    has fewer than two, the tokens around that. ``part``: more of a number may follow;
    ``glue``: what parts this token from the one before, if it may go on with that.
    """

    def one(value: Column, start: Column, gap: Column) -> Column:
        follows = value.rlike(_NEXT) & gap.rlike(_GLUE)
        return F.struct(
            start.alias("start"), value.alias("value"),
            F.nullif(F.regexp_extract(gap, _LAST, 1), F.lit("")).alias("last"),
            F.nullif(F.regexp_extract(gap, _SECOND, 1), F.lit("")).alias("second"),
            F.nullif(F.regexp_extract(gap, _FIRST, 1), F.lit("")).alias("first"),
            F.when(follows, gap).alias("glue"),
            (value.rlike(_PART) & (F.length(_digits(value)) < _WHOLE_DIGITS)).alias("part"),
        )

    def placed(found: Column) -> Column:
        def token(t: Column, i: Column) -> Column:
            back, back2 = F.get(found, i - 1), F.get(found, i - 2)
            last = F.coalesce(t["last"], back["value"])
            second = F.coalesce(
                t["second"],
                F.when(t["last"].isNotNull(), back["value"]).otherwise(F.coalesce(back["last"], back2["value"])),
            )
            after = F.get(found, i + 1)
            right = F.coalesce(after["first"], after["value"])
            return F.struct(
                F.lit("token").alias("kind"), t["start"].alias("start"),
                (t["start"] + F.length(t["value"])).alias("end"), t["value"].alias("value"),
                _classes(F.concat(second, F.lit(" "), last)).alias("pair"), _classes(last).alias("last"),
                _classes(right).alias("right"), t["glue"].alias("glue"), t["part"].alias("part"),
            )

        return F.transform(found, token)

    return let(matches(text, _TOKEN, one), placed)


def _joined_parts(tokens: Column) -> Column:
    """``tokens`` with neighbours that are parts of one number as one, in order."""

    def goes_on(t: Column, i: Column) -> Column:
        back = F.get(tokens, i - 1)
        return F.coalesce(back["part"] & (back["end"] + F.length(t["glue"]) == t["start"]), F.lit(False))

    def one(heads: Column, first: Column, k: Column) -> Column:
        until = F.coalesce(F.get(heads, k + 1), F.size(tokens))
        parts = F.slice(tokens, first + 1, until - first)
        value = F.array_join(
            F.transform(parts, lambda p, j: F.when(j == 0, p["value"]).otherwise(F.concat(p["glue"], p["value"]))), ""
        )
        last = F.get(tokens, until - 1)
        return _place(F.get(tokens, first), F.get(tokens, first), last, last["end"], value)

    heads = F.filter(
        F.sequence(F.lit(0), F.size(tokens) - 1), lambda i: ~goes_on(F.get(tokens, i), i)
    )
    return F.when(F.size(tokens) > 0, let(heads, lambda h: F.transform(h, lambda first, k: one(h, first, k))))


def _place(
    span: Column, before: Column, after: Column, end: Column | None = None, value: Column | None = None
) -> Column:
    """A span with the words before the token ``before`` and behind the token ``after``."""
    return F.struct(
        span["kind"].alias("kind"), span["start"].alias("start"), (span["end"] if end is None else end).alias("end"),
        (span["value"] if value is None else value).alias("value"),
        before["pair"].alias("pair"), before["last"].alias("last"), after["right"].alias("right"),
    )


def base_spans(text: Column) -> dict[str, Column]:
    """The spans that are reported by themselves, per kind."""
    has_digit = text.rlike("[0-9]")
    n = lambda v: F.length(_digits(v))
    found = {
        "email": (F.contains(text, F.lit("@")), _EMAIL, None),
        "ip": (has_digit, _IP, lambda v: v.rlike(_PARTS)),
        "card": (has_digit, _CARD, lambda v: F.when(n(v).between(16, 19), _luhn(v)).otherwise(False)),
        "phone": (F.contains(text, F.lit("+")), _PHONE, lambda v: n(v).between(8, 15)),
    }
    return {
        kind: F.when(where, spans(text, kind, pattern, keep)).otherwise(empty())
        for kind, (where, pattern, keep) in found.items()
    }


def score_patterns(
    pairs: DataFrame, scratch: Scratch, *, rounds: int = ROUNDS, least_seeds: int = LEAST_SEEDS,
    least_confidence: float = LEAST_CONFIDENCE, shape_confidence: float = SHAPE_CONFIDENCE,
) -> DataFrame:
    """``(pattern, n, kind, confidence, trusted)`` of the patterns of ``pairs(pattern, value,
    kind)``; a pattern without any belief has a null kind and confidence 0.

    ``pairs`` are the distinct edges of the pattern-instance graph; ``kind`` is that of a
    seed and null for an instance not known yet. In each round a pattern's confidence in
    a kind is the belief in its instances of that kind over all its instances (``n``); patterns
    with ``least_seeds`` worth of belief and ``least_confidence`` are trusted, and give
    their confidence to their unknown instances as belief (the best one counts) for the
    next round. Sums are combined before they move, so a pattern may be very common.
    """
    seeds = pairs.where("kind is not null").select("value", "kind").distinct()
    beliefs = seeds.withColumn("belief", F.lit(1.0))
    edges = pairs.select("pattern", "value").distinct()
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    sizes, _ = scratch.save(sizes, "sizes")
    is_shape = F.substring_index("pattern", ":", 1).isin(*SHAPES)
    least = F.when(is_shape, shape_confidence).otherwise(least_confidence)
    scored = None
    for k in range(rounds):
        held = edges.join(beliefs, "value").groupBy("pattern", "kind").agg(
            (F.sum(F.round(F.col("belief") * 1_000_000).cast("long")) / 1_000_000).alias("held")
        )
        scores = held.join(sizes, "pattern").withColumn("confidence", F.col("held") / F.col("n"))
        trusted = (F.col("held") >= least_seeds) & (F.col("confidence") >= least)
        best = F.max(F.struct("confidence", "kind", trusted.alias("trusted"))).alias("best")
        scored = scores.groupBy("pattern").agg(best).select("pattern", "best.*")
        scored, _ = scratch.save(scored, "patterns")
        if k + 1 < rounds:
            found = edges.join(scored.where("trusted"), "pattern").join(seeds.select("value"), "value", "left_anti")
            found = found.groupBy("value", "kind").agg(F.max("confidence").alias("belief"))
            beliefs, _ = scratch.save(seeds.withColumn("belief", F.lit(1.0)).unionByName(found), "beliefs")
    return sizes.join(scored, "pattern", "left").select(
        "pattern", "n", "kind", F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
        F.coalesce("trusted", F.lit(False)).alias("trusted"),
    )


def learn_patterns(pairs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """``(pattern, kind, confidence)``: the trusted patterns of ``score_patterns``."""
    return score_patterns(pairs, scratch, **options).where("trusted").select("pattern", "kind", "confidence")


def _refused() -> Column:
    """A value that a base rule has looked at and refused by its digits: no candidate."""
    value = F.col("value")
    number = value.rlike(r"^[0-9](?:[\x20-]?[0-9])++\z") & F.length(_digits(value)).between(16, 19)
    address = value.rlike(r"^[0-9]++(?:\.[0-9]++){3}\z")
    return F.when(number, ~_luhn(value)).when(address, ~value.rlike(_PARTS)).otherwise(False)


def mark_places(places: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """The unknown rows of ``places(row, start, end, value, forms, kind)`` that patterns mark,
    with their kind.

    The most special form of a place that is trusted, or that is known from SURE_INSTANCES
    different values without being trusted, decides; only where the words around a value are
    too rare to say anything is it judged by a more general form. A number of card length
    with a wrong check digit and an address with too large parts take no part. Places move by
    pattern, one row for each form.
    """
    places = places.where(F.col("kind").isNotNull() | ~_refused())
    each = places.select("row", "start", "end", "value", "kind", F.posexplode("forms").alias("form", "pattern"))
    each = each.where("pattern is not null")
    pairs = each.select("pattern", "value", "kind").distinct()
    scored = score_patterns(pairs, scratch, **options).where(F.col("trusted") | (F.col("n") >= SURE_INSTANCES))
    known = each.where("kind is null").drop("kind").join(scored, "pattern")
    decided = known.groupBy("row", "start", "end", "value").agg(
        F.min(F.struct("form", "trusted", "kind")).alias("by")
    )
    return decided.where("by.trusted").select("row", "start", "end", "value", "by.kind")


def find_personal_data(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """``(doc_id, email, ip, card, phone, found)``: spans with kind, start, end and value.

    The base kinds are seeds. A candidate is a word that holds a digit or an at sign, with
    the neighbours that are parts of the same number: "(545) 555-1234" and "545 555 1234"
    are one, numbers with other signs, more blanks or line ends between them are several.
    The patterns of a seed or a candidate are the words around the word that it begins in,
    and the shape of its value, in several ``FORMS``; trusted patterns mark further
    candidates as that kind (``mark_places``). ``found`` has base and further spans by kind and
    then start.
    Offsets are code points, the end is exclusive. A null text is empty, an empty one has
    no spans; every row gives a row, equal rows equal spans. Only spans and their
    patterns are moved, never texts.
    """
    text = F.col("text")
    tokens = F.when(text.rlike("[0-9@]"), _tokens(text)).otherwise(empty(_TOKEN_TYPE))
    rows = docs.select("doc_id", text_of().alias("text")).select(
        "doc_id", row_key().alias("row"), *[c.alias(kind) for kind, c in base_spans(text).items()],
        tokens.alias("tokens"),
    )
    rows, _ = scratch.save(rows, "spans")
    more = mark_places(_stored_places(rows, scratch), scratch, **options).groupBy("row").agg(
        F.collect_set(F.struct("kind", "start", "end", "value")).alias("more")
    )
    found = in_order(F.concat(*KINDS, F.coalesce("more", empty())), KINDS, by_start=False)
    return rows.join(more, "row", "left").select("doc_id", *KINDS, found.alias("found"))


def _stored_places(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``(row, start, end, value, forms, kind)`` of seeds and candidates, signs around left off."""
    # Every base span begins in a token.
    seeds = F.transform(
        F.concat(*KINDS),
        lambda s: let(
            F.filter("tokens", lambda t: (t["start"] < s["end"]) & (s["start"] < t["end"])),
            lambda own: _place(s, own[0], F.element_at(own, -1)),
        ),
    )
    # A token that a base span reaches into is that span.
    free = F.filter(
        "tokens", lambda t: ~F.exists(F.concat(*KINDS), lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
    )
    places = rows.select("row", seeds.alias("seeds"), free.alias("free")).select(
        "row", F.explode(F.concat("seeds", F.coalesce(_joined_parts(F.col("free")), F.array()))).alias("c")
    ).select("row", "c.*")
    bare = F.regexp_replace("value", _SIGNS, "")
    start = F.col("start") + F.length("value") - F.length(bare)
    value = F.regexp_replace(bare, r"[^A-Za-z0-9]+$", "")
    places = places.select(
        "row", start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"),
        "pair", "last", "right", F.expr("nullif(kind, 'token')").alias("kind"),
    ).where("value <> ''")
    places = places.select("row", "start", "end", "value", _forms().alias("forms"), "kind")
    return scratch.save(places, "places")[0]


def hidden_recall(docs: DataFrame, scratch: Scratch, one_in: int = 3, **options) -> DataFrame:
    """``(kind, n_hidden, n_found, n_marked)``: how many of the seeds come back if one value in
    ``one_in`` is taken for unknown. ``n_marked`` counts all places that patterns mark as the
    kind, ``n_found`` those that are hidden seeds of it."""
    text = F.col("text")
    tokens = F.when(text.rlike("[0-9@]"), _tokens(text)).otherwise(empty(_TOKEN_TYPE))
    rows = docs.select("doc_id", text_of().alias("text")).select(
        row_key().alias("row"), *[c.alias(kind) for kind, c in base_spans(text).items()], tokens.alias("tokens")
    )
    rows, _ = scratch.save(rows, "spans")
    places = _stored_places(rows, scratch)
    hidden = F.pmod(F.xxhash64("value"), F.lit(one_in)) == 0
    marked = mark_places(places.withColumn("kind", F.when(~hidden, F.col("kind"))), scratch, **options)
    asked = places.where(hidden & F.col("kind").isNotNull()).select("row", "start", "kind").distinct()
    told = marked.select("row", "start", "kind").distinct()
    n_asked = asked.groupBy("kind").agg(F.count(F.lit(1)).alias("n_hidden"))
    n_found = asked.join(told, ["row", "start", "kind"]).groupBy("kind").agg(F.count(F.lit(1)).alias("n_found"))
    n_marked = told.groupBy("kind").agg(F.count(F.lit(1)).alias("n_marked"))
    return n_asked.join(n_found, "kind", "left").join(n_marked, "kind", "left").na.fill(0)


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find_personal_data(table(spark, sf_dir, "documents"), Scratch(spark))
    base = in_order(F.concat(*KINDS), KINDS, by_start=False)
    return rows.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )
