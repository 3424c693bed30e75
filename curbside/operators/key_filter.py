"""A filter of keys, to send past a shuffle only the rows whose key may be among given ones.

Each key sets four bits of one 64-bit word that its hash picks. The number of words follows the number of keys: 16 to 32
bits a key, which lets some 0.3 % of other keys pass. The words are broadcast as arrays, 64 MB at most. Where more keys
come than these bits can tell apart, nothing is filtered and the exact step after it gets all rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
MOST_WORDS = 1 << 23  # 64 MB
MOST_KEYS = MOST_WORDS * 64 // 4  # at four bits a key and beyond the filter lets most keys pass
ROW_WORDS = 1 << 12


def _word(key: Column, words: int) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(words - 1))


def _places(key: Column) -> list[Column]:
    """The four bits of a key in its word; some may coincide."""
    places = F.xxhash64(key, F.lit(1))
    return [F.shiftright(places, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(4)]


def _mask(key: Column) -> Column:
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in _places(key)]
    return reduce(Column.bitwiseOR, bits)


class KeyFilter:
    """Of the column `_key` of `keyed`, which has about `n` distinct values."""

    def __init__(self, keyed: DataFrame, n: int):
        self.words = 1 << max(6, (max(1, n) * BITS_PER_KEY // 64 - 1).bit_length())
        self.open = n > MOST_KEYS
        self.words = min(self.words, MOST_WORDS)
        if self.open:
            return
        set_bits = keyed.select(_word(F.col("_key"), self.words).alias("word"), _mask(F.col("_key")).alias("bits"))
        every = keyed.sparkSession.range(self.words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
        # dealt out by row once; both groupings after it find their rows in place
        dealt = set_bits.union(every).withColumn("_segment", F.shiftright("word", 12)).repartition("_segment")
        merged = dealt.groupBy("_segment", "word").agg(F.bit_or("bits").alias("bits"))
        in_row = F.array_sort(F.collect_list(F.struct("word", "bits")))["bits"]
        self.rows = merged.groupBy("_segment").agg(in_row.alias("_bits"))

    def tag(self, rows: DataFrame, key: Column, name: str) -> DataFrame:
        """`rows` with a column that is false where the key is surely not among the filter's."""
        if self.open:
            return rows.withColumn(name, F.lit(True))
        joined = rows.withColumn("_at", _word(key, self.words)).join(
            F.broadcast(self.rows), F.shiftright("_at", 12) == F.col("_segment")
        )
        found = F.get("_bits", F.col("_at").bitwiseAND(F.lit(ROW_WORDS - 1)).cast("int"))
        hit = reduce(Column.__and__, [F.getbit(found, place) == 1 for place in _places(key)])
        return joined.withColumn(name, hit).drop("_at", "_segment", "_bits")

    def cut(self, rows: DataFrame, key: Column) -> DataFrame:
        """The rows whose key may be among the filter's."""
        return rows if self.open else self.tag(rows, key, "_possible").where("_possible").drop("_possible")
