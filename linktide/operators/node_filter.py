"""A bounded bit filter of node ids: most links to pages that do not exist never move.

Each id sets three bits of one 64-bit word. The words are broadcast, and a link whose bits are
not all set has no page at that end. A filter never drops a link between pages; what it
lets through by chance is dropped by the exact join behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linktide.scratch import Scratch

BITS_PER_NODE = 16
# A million words of 16 bytes are broadcast at most. From MOST_NODES on they would be so full
# that most red links pass: then there is no filter, and all links move as they do anyway.
MOST_WORDS = 1 << 20
MOST_NODES = MOST_WORDS * 64 // 6


class NodeFilter:
    """``keep`` drops rows that have no node at ``key``; built once, used for either end."""

    def __init__(self, nodes: DataFrame, n_nodes: int, scratch: Scratch):
        self.table = None
        if not 0 < n_nodes <= MOST_NODES:
            return
        self.n_words = min(MOST_WORDS, -(-n_nodes * BITS_PER_NODE // 64))
        word, mask = self._place("id")
        table = nodes.groupBy(word.alias("filter_word")).agg(F.bit_or(mask).alias("filter_bits"))
        self.table, _ = scratch.save(table, "filter")

    def _place(self, key: str) -> tuple[Column, Column]:
        h = F.xxhash64(F.lit("node"), key)
        one = F.lit(1).cast("long")
        bits = [
            F.call_function("shiftleft", one, F.shiftrightunsigned(h, 6 * k).bitwiseAND(63).cast("int"))
            for k in range(3)
        ]
        word = F.pmod(F.shiftrightunsigned(h, 20), F.lit(self.n_words))
        return word, bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])

    def keep(self, links: DataFrame, key: str) -> DataFrame:
        if self.table is None:
            return links
        word, mask = self._place(key)
        found = links.withColumn("filter_word", word).join(F.broadcast(self.table), "filter_word")
        return found.where(F.col("filter_bits").bitwiseAND(mask) == mask).select(links.columns)
