"""A Bloom filter of a table's keys, as a Spark expression.

The filter is an array of 64-bit words. Each key sets ``HASHES`` bits; the bits are
or-ed per word by a grouping, and the words come together in one row, which the
planner hands to every task as a scalar subquery. Its size follows from the number
of keys, which is counted first: ``BITS_PER_KEY`` bits a key, and no filter at all
beyond ``max_bytes``. It refuses no key of the table, and lets about one in a hundred
of the others pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playstats.scratch import stored

BITS_PER_KEY, HASHES = 10, 7
MAX_BYTES = 16 << 20


def _comparable(column: Column, mine: T.DataType, other: T.DataType) -> Column:
    """A form that is equal wherever ``=`` says so."""
    if isinstance(mine, T.NumericType) and isinstance(other, T.NumericType) and (
            mine != other or isinstance(mine, (T.DoubleType, T.FloatType))):
        return column.cast("double") + F.lit(0.0)  # 0.0 and -0.0 are equal
    return column if mine == other else column.cast("string")


def _bits(keys: Sequence[Column], n_bits: int | Column) -> list[Column]:
    n_bits = F.lit(n_bits) if isinstance(n_bits, int) else n_bits
    first, step = (F.pmod(F.xxhash64(F.lit(seed), *keys), n_bits) for seed in (17, 71))
    return [(first + step * i) % n_bits for i in range(HASHES)]


class BloomFilter:
    """The keys of ``table``. Rows with a NULL in a key have no key."""

    def __init__(self, table: DataFrame, keys: Sequence[str], n_keys: int):
        self.types = [table.schema[k].dataType for k in keys]
        self.n_words = max(1, -(-n_keys * BITS_PER_KEY // 64))
        self.n_bits = 64 * self.n_words
        self._table, self._keys = table, list(keys)
        self._words: DataFrame | None = None
        self._for: list[T.DataType] | None = None

    @classmethod
    def of(cls, table: DataFrame, keys: Sequence[str], max_bytes: int = MAX_BYTES) -> BloomFilter | None:
        """None if the filter would take more than ``max_bytes``."""
        n = table.count()
        return cls(table, keys, n) if n * BITS_PER_KEY <= 8 * max_bytes else None

    def _array(self, others: list[T.DataType]) -> Column:
        if self._words is None or self._for != others:
            own = [_comparable(F.col(f"`{k}`"), t, o) for k, t, o in zip(self._keys, self.types, others)]
            bit = F.explode(F.array(*_bits(own, self.n_bits))).alias("bit")
            known = self._table.dropna(subset=self._keys).select(bit)
            words = known.groupBy(F.floor(F.col("bit") / 64).alias("i")).agg(
                F.bit_or(F.expr("shiftleft(1L, int(bit % 64))")).alias("w"))
            every = self._table.sparkSession.range(self.n_words).withColumnRenamed("id", "i").join(words, "i", "left")
            self._words, self._for = stored(every.select("i", F.coalesce("w", F.lit(0).cast("long")).alias("w")), "bloom"), others
        one = self._words.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "w"))), lambda x: x["w"]).alias("words"))
        return one.scalar()

    def might_hold(self, df: DataFrame, keys: Sequence[str]) -> Column:
        """False only for rows whose key is not in the table, or holds a NULL."""
        others = [df.schema[k].dataType for k in keys]
        words = self._array(others)
        cols = [F.col(f"`{k}`") for k in keys]
        own = [_comparable(c, o, t) for c, o, t in zip(cols, others, self.types)]
        cond = F.lit(True)
        for c in cols:
            cond = cond & c.isNotNull()
        for bit in _bits(own, self.n_bits):
            cond = cond & (F.getbit(F.element_at(words, (F.floor(bit / 64) + 1).cast("int")), (bit % 64).cast("int")) == 1)
        return cond


# ------------------------------------------------------------ one filter for each group of a table

def filter_words(keys: DataFrame, group: str) -> DataFrame:
    """(group, n_words, i, w): for each group of rows (key, group) the words of a filter of
    its keys that are not zero. NULL keys are in no filter."""
    keys = keys.filter(F.col("key").isNotNull())
    sizes = keys.groupBy(group).agg(F.ceil(F.count(F.lit(1)) * BITS_PER_KEY / 64).alias("n_words"))
    bits = keys.join(sizes, group).select(group, "n_words", F.explode(F.array(*_bits([F.col("key")], F.col("n_words") * 64))).alias("bit"))
    return bits.groupBy(group, "n_words", F.floor(F.col("bit") / 64).alias("i")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(bit % 64))")).alias("w"))


def probable(keys: DataFrame, words: DataFrame, group: str) -> DataFrame:
    """The distinct (key, group) of ``keys`` that the group's filter lets pass. Only the words
    that a key asks for meet it, by a join."""
    keys = keys.filter(F.col("key").isNotNull()).select("key", group).distinct()
    sizes = words.select(group, "n_words").distinct()  # a row for each group
    asked = keys.join(sizes, group).select("key", group, F.explode(F.array_distinct(F.array(
        *_bits([F.col("key")], F.col("n_words") * 64)))).alias("bit"), F.lit(1).alias("_one"))
    asked = asked.withColumn("i", F.floor(F.col("bit") / 64))
    held = asked.join(words.select(group, "i", "w"), [group, "i"], "left").withColumn(
        "_set", F.getbit(F.coalesce("w", F.lit(0).cast("long")), (F.col("bit") % 64).cast("int")))
    return held.groupBy("key", group).agg(F.min("_set").alias("_all")).filter("_all = 1").select("key", group)
