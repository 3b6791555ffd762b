"""Hot keys: found by an exact pre-aggregated count, then kept out of the shuffles.

A key is hot when it holds more than ``max(floor, total / MAX_HOT_KEYS)`` rows, so
there are fewer than MAX_HOT_KEYS of them however large the input is. They are carried
by hashes of fixed size, whatever their length, which bounds what is broadcast to about
20 MB.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linktide.scratch import Scratch

HOT_ROWS = 200_000
MAX_HOT_KEYS = 200_000
# Keys are first counted by slots of their hashes, so many that a slot holds a sixteenth of a
# hot key's rows on average. Where that takes more than MAX_SLOTS, keys are counted at once.
SLOTS_PER_KEY = 16
MAX_SLOTS = 1 << 17
_HASHES = ("hot_hash_1", "hot_hash_2")


def hot_threshold(total: int, floor: int = HOT_ROWS) -> int:
    return max(floor, -(-total // MAX_HOT_KEYS))


def _hashed(df: DataFrame, key: str) -> DataFrame:
    """``df`` with two 64-bit hashes of the key."""
    named = F.col(key)
    return df.withColumns({h: F.xxhash64(F.lit(h), named) for h in _HASHES})


def _digest(key: str) -> Column:
    """32 bytes that stand for a key of any length."""
    return F.unhex(F.sha2(F.col(key).cast("string").cast("binary"), 256))


def hot_keys(
    df: DataFrame,
    key: str,
    total: int,
    scratch: Scratch,
    floor: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame | None:
    """``(hot_hash_1, hot_hash_2, n_parts, n_rows)`` of the hot keys; None if there are none.

    ``total`` is the row count of ``df`` or a number above it, ``counted`` the rows per
    key (``key``, ``n_rows``) where they are known already. ``n_parts`` is how many
    groups bring the key below the threshold again.
    """
    return _keys_above(df, key, total, scratch, hot_threshold(total, floor), counted)[0]


def _keys_above(
    df: DataFrame,
    key: str,
    total: int,
    scratch: Scratch,
    threshold: int,
    counted: DataFrame | None = None,
) -> tuple[DataFrame | None, int]:
    if total <= threshold:
        return None, 0
    if counted is None:
        df = _full_slots(df, key, total, scratch, threshold)
        if df is None:
            return None, 0
        counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    hot = _hashed(counted.where(F.col("n_rows") > threshold), key)
    parts = F.max(F.ceil(F.col("n_rows") / threshold)).alias("n_parts")
    hot = hot.groupBy(*_HASHES).agg(parts, F.max("n_rows").alias("n_rows"))
    stored, seen = scratch.save(hot, f"hot_{key}", {"n": F.count(F.lit(1))})
    return (stored if seen["n"] else None), seen["n"]


def _full_slots(
    df: DataFrame, key: str, total: int, scratch: Scratch, threshold: int
) -> DataFrame | None:
    """``(key)`` of the rows whose hash slot has more than ``threshold`` rows, as that of a hot
    key has; None if no slot has. A count per slot moves a few numbers instead of all keys.
    """
    n_slots = SLOTS_PER_KEY * -(-total // threshold)
    if n_slots > MAX_SLOTS:
        return df.select(key)
    slot = F.pmod(F.xxhash64(F.lit("slot"), F.col(key)), F.lit(n_slots)).cast("int")
    slotted = df.select(key, slot.alias("hot_slot"))
    full = slotted.groupBy("hot_slot").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > threshold)
    full, seen = scratch.save(full.select("hot_slot"), f"slots_{key}", {"n": F.count(F.lit(1))})
    if not seen["n"]:
        return None
    return slotted.join(F.broadcast(full), "hot_slot", "left_semi").select(key)


def semi_join(
    df: DataFrame,
    key: str,
    ids: DataFrame,
    total: int,
    scratch: Scratch,
    floor: int = HOT_ROWS,
    distinct: bool = False,
    counted_in: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in the distinct ``ids.id``; ``distinct`` ones only.

    Rows of hot keys stay where they are and meet a broadcast; the others shuffle
    and probe a hash table of their partition's ids, so that they need no sort. No key
    is on both sides, so each side can drop duplicates by itself: the cold side where
    its rows are after the join, the hot side with a combine before its shuffle.
    ``df`` is read once per side if there are hot keys. ``counted_in`` has all rows of ``df``,
    and maybe more, where they are cheaper to count.
    """
    wanted = ids.select(F.col("id").alias(key))
    # As ids are distinct, an inner join: Spark would push a semi join below other joins of
    # ``df``, such as a filter that is to keep rows from moving.
    probed = wanted.hint("shuffle_hash")
    hot = hot_keys(df if counted_in is None else counted_in, key, total, scratch, floor)
    if hot is None:
        sides = [df.join(probed, key)]
    else:
        hot = F.broadcast(hot.select(*_HASHES))
        hot_wanted = _hashed(wanted, key).join(hot, list(_HASHES), "left_semi")
        hot_wanted = hot_wanted.select(_digest(key).alias("hot_digest"))
        hashed = _hashed(df, key)
        hot_rows = hashed.join(hot, list(_HASHES), "left_semi").withColumn("hot_digest", _digest(key))
        sides = [
            hashed.join(hot, list(_HASHES), "left_anti").join(probed, key),
            hot_rows.join(F.broadcast(hot_wanted), "hot_digest", "left_semi"),
        ]
    sides = [side.select(df.columns) for side in sides]
    if distinct:
        sides = [side.distinct() for side in sides]
    return reduce(DataFrame.union, sides)


def lookup(
    df: DataFrame,
    key: str,
    table: DataFrame,
    total: int,
    scratch: Scratch,
    floor: int = HOT_ROWS,
    distinct: bool = False,
    counted_in: DataFrame | None = None,
) -> DataFrame:
    """``df`` with what ``table`` (one row per ``id``) has for its ``key``; other rows drop out.

    As in ``semi_join``, rows of hot keys stay where they are and meet a broadcast of the
    hot ids' rows, the others shuffle and probe a hash table; ``distinct`` rows likewise.
    ``counted_in`` has all rows of ``df``, and maybe more, where they are cheaper to count.
    """
    values = [c for c in table.columns if c != "id"]
    probed = table.withColumnRenamed("id", key)
    hot = hot_keys(df if counted_in is None else counted_in, key, total, scratch, floor)
    if hot is None:
        found = df.join(probed.hint("shuffle_hash"), key).select(*df.columns, *values)
        return found.distinct() if distinct else found
    hot = F.broadcast(hot.select(*_HASHES))
    hot_table = _hashed(probed, key).join(hot, list(_HASHES), "left_semi")
    hot_table = hot_table.select(_digest(key).alias("hot_digest"), *values)
    hashed = _hashed(df, key)
    hot_rows = hashed.join(hot, list(_HASHES), "left_semi").withColumn("hot_digest", _digest(key))
    hot_rows = hot_rows.join(F.broadcast(hot_table), "hot_digest")
    cold_rows = hashed.join(hot, list(_HASHES), "left_anti").join(probed.hint("shuffle_hash"), key)
    sides = [side.select(*df.columns, *values) for side in (hot_rows, cold_rows)]
    if distinct:
        sides = [side.distinct() for side in sides]
    return reduce(DataFrame.union, sides)


class KeyParts:
    """How the rows of keys with more than ``floor`` rows are dealt over parts.

    What part a row is in hangs on its key's rows and ``floor`` alone, not on ``total``.
    Up to MAX_HOT_KEYS keys are broadcast; with more they are joined in a shuffle.
    """

    def __init__(
        self,
        df: DataFrame,
        key: str,
        total: int,
        scratch: Scratch,
        floor: int = HOT_ROWS,
        counted: DataFrame | None = None,
    ):
        hot, n_hot = _keys_above(df, key, total, scratch, floor, counted)
        self._hot = F.broadcast(hot) if hot is not None and n_hot <= MAX_HOT_KEYS else hot

    def keys(self, key: str) -> list[str]:
        """What rows are dealt by before they are grouped by key and part. Where no key has
        several, the part is a constant that grouping leaves out, and would move rows twice."""
        return [key] if self._hot is None else [key, "part"]

    def of_rows(self, df: DataFrame, key: str, spread: str) -> DataFrame:
        """Add ``part`` and ``key_rows``: 0 and null for keys of one part, a hash of
        ``spread`` and the key's rows for others."""
        if self._hot is None:
            return df.withColumns({"part": F.lit(0).cast("long"), "key_rows": F.lit(None).cast("long")})
        part = F.coalesce(F.pmod(F.xxhash64(spread), F.col("n_parts")), F.lit(0))
        return _hashed(df, key).join(self._hot, list(_HASHES), "left").select(
            *df.columns, part.cast("long").alias("part"), F.col("n_rows").alias("key_rows")
        )

    def per_part(self, df: DataFrame, key: str) -> DataFrame:
        """``df``, one row per key, once for each ``part`` of its key: what is joined with the
        parts of a key by ``key`` and ``part`` does not meet all of them in one place."""
        if self._hot is None:
            return df.withColumn("part", F.lit(0).cast("long"))
        last = F.coalesce(F.col("n_parts"), F.lit(1)) - 1
        parts = F.sequence(F.lit(0).cast("long"), last.cast("long"))
        return _hashed(df, key).join(self._hot, list(_HASHES), "left").select(
            *df.columns, F.explode(parts).alias("part")
        )


def with_parts(
    df: DataFrame,
    key: str,
    spread: str,
    total: int,
    scratch: Scratch,
    floor: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """``KeyParts.of_rows`` where the parts are used once; ``counted`` as in ``hot_keys``."""
    return KeyParts(df, key, total, scratch, floor, counted).of_rows(df, key, spread)
