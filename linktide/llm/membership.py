"""A bounded filter for ids: says of most rows that they are not among them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linktide.scratch import Scratch

BITS_PER_ID = 32
# At most 2 million rows of 16 bytes are broadcast. With more ids than a 32nd of the bits
# the filter lets more rows pass that an exact join then has to drop; it never drops one.
MOST_BITS = 1 << 27


class IdFilter:
    """Whole-number ids as bits of a table ``(word, bits)``, which is broadcast."""

    def __init__(self, ids: DataFrame, column: str, scratch: Scratch):
        ids, seen = scratch.save(ids.select(column), "ids", {"n": F.count(F.lit(1))})
        self.size = min(MOST_BITS, max(64, seen["n"] * BITS_PER_ID))
        word, bit = self._place(column)
        table = ids.where(F.col(column).isNotNull()).groupBy(word.alias("filter_word")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("filter_bits")
        )
        self.table, _ = scratch.save(table, "bits")

    def _place(self, column: str) -> tuple[Column, Column]:
        place = F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(self.size))
        return F.floor(place / 64).cast("long"), F.pmod(place, F.lit(64)).cast("int")

    def split(self, rows: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
        """``(rows that may be among the ids, rows that are not)``; null is not."""
        word, bit = self._place(column)
        marked = rows.withColumn("filter_word", F.when(F.col(column).isNotNull(), word))
        marked = marked.join(F.broadcast(self.table), "filter_word", "left")
        bits = F.coalesce("filter_bits", F.lit(0).cast("long"))
        known = F.call_function("shiftright", bits, bit).bitwiseAND(F.lit(1).cast("long")) == 1
        columns = [F.col(f"`{c}`") for c in rows.columns]
        return marked.where(known).select(columns), marked.where(~known).select(columns)
