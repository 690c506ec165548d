"""Membership by a fixed-size bit filter of 64-bit hashes (C25), with an exact check of what it lets pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn import shared

#: Bits of a filter; its table has at most this over 64 rows, however many members there are.
BITS = 1 << 22
HASHES = 2


@dataclass(frozen=True)
class HashFilter:
    """``words``: (word, mask), at most ``bits`` / 64 rows, so broadcasting it is bounded (1 MB of longs)."""

    words: DataFrame
    bits: int
    hashes: int

    @staticmethod
    def _bit(key: Column, number: int, bits: int) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(number)), F.lit(bits))

    @classmethod
    def of(cls, members: DataFrame, key: str, *, bits: int = BITS, hashes: int = HASHES) -> "HashFilter":
        """Bits are or-ed inside each task first, so at most a row for each word and task is shuffled."""
        bit = F.explode(F.array(*[cls._bit(F.col(key), i, bits) for i in range(hashes)]))
        set_bits = members.filter(F.col(key).isNotNull()).select(bit.alias("b")).select(F.floor(F.col("b") / 64).cast("long").alias("word"), F.expr("shiftleft(1L, cast(b % 64 as int))").alias("one"))
        return cls(shared.written(members.sparkSession, set_bits.groupBy("word").agg(F.bit_or("one").alias("mask")), "filter"), bits, hashes)

    def may_hold(self, df: DataFrame, key: str) -> DataFrame:
        """The rows whose key may be a member: all that are, and some that are not."""
        out = df
        for i in range(self.hashes):
            bit = self._bit(F.col(key), i, self.bits)
            words = F.broadcast(self.words.select(F.col("word").alias("_word"), F.col("mask").alias("_mask")))
            out = out.withColumn("_bit", bit).join(words, F.floor(F.col("_bit") / 64).cast("long") == F.col("_word"))
            out = out.filter(F.expr("shiftrightunsigned(_mask, cast(_bit % 64 as int)) & 1 = 1")).drop("_bit", "_word", "_mask")
        return out


def semi(df: DataFrame, members: DataFrame, key: str, filter_: HashFilter | None = None) -> DataFrame:
    """The rows of ``df`` whose key is a member: the filter drops most others where they are read, the rest is compared exactly."""
    found = (filter_ or HashFilter.of(members, key)).may_hold(df, key)
    return found.join(members.select(key).distinct(), key, "left_semi")


def retention(df: DataFrame, members: DataFrame, key: str, filter_: HashFilter) -> DataFrame:
    """(rows, retained, members, over): what the filter let pass, and how many of that are no members."""
    passed = filter_.may_hold(df, key).join(members.select(key).distinct().withColumn("_in", F.lit(True)), key, "left")
    counts = passed.agg(F.count("*").alias("retained"), F.count("_in").alias("members"))
    return df.agg(F.count("*").alias("rows")).join(F.broadcast(counts)).withColumn("over", F.col("retained") - F.col("members"))  # two rows of counts
