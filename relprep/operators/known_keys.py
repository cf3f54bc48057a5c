"""Uniqueness across loads (DQ-1, DQ-4): which keys of a load are known from earlier ones.

A unique column of a table that grows by loads would have to be grouped as a
whole after each of them.  ``KnownKeys`` keeps the keys of all loads and a
split-block Bloom filter of them: blocks of 256 bits, each key setting one bit
in each of its block's four words.  The filter is a table of one row a block,
some ten bits a key, built and merged by ``bit_or``.

A load's keys meet the filter by their block (the one shuffle, of the new keys
and the filter), and only possible hits, about one in a hundred of the new
keys, and the true repeats, are looked up in the keys themselves: those are
scanned, not shuffled, where the hits are small enough to be broadcast.
The answer is exact; a filter that has become too full costs time only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from relprep.sources.batches import BatchTable

#: Words of 64 bits in a block.
WORDS = 4
_MASKS = [f"m{i}" for i in range(WORDS)]


def blocks_for(keys: int, bits_per_key: int = 10) -> int:
    """How many blocks suit that many keys."""
    return max(1, -(-keys * bits_per_key // (64 * WORDS)))


def placed(keys: DataFrame, cols: list[str], blocks: int) -> DataFrame:
    """``keys`` with the block of each and its bit in each of the block's words."""
    h = F.xxhash64(*cols)
    masks = [F.expr(f"shiftleft(1L, cast(shiftright(__bits, {6 * i}) & 63 as int))").alias(m) for i, m in enumerate(_MASKS)]
    hashed = keys.select(*cols, F.pmod(h, F.lit(blocks).cast("long")).alias("block"), F.xxhash64(h, F.lit(WORDS)).alias("__bits"))
    return hashed.select(*cols, "block", *masks)


class KnownKeys:
    """The keys of all loads of a table in ``path``; null keys are not keys."""

    def __init__(self, spark: SparkSession, path: str, layout: StructType, blocks: int):
        self.cols, self.blocks = layout.names, blocks
        self.keys = BatchTable(spark, f"{path}/keys", layout)
        self.filter = BatchTable(spark, f"{path}/filter", StructType.fromDDL("block long, " + ", ".join(f"{m} long" for m in _MASKS)))

    def _distinct(self, df: DataFrame) -> DataFrame:
        not_null = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in self.cols])
        return df.where(not_null).select(*self.cols).distinct()

    def repeated(self, df: DataFrame) -> DataFrame:
        """The distinct keys of ``df`` that an earlier load had."""
        known = self.filter.read().groupBy("block").agg(*[F.bit_or(m).alias(f"k{m}") for m in _MASKS])
        new = placed(self._distinct(df), self.cols, self.blocks)
        possible = reduce(lambda a, b: a & b, [F.col(m).bitwiseAND(F.col(f"k{m}")) != 0 for m in _MASKS])
        hits = new.join(known, "block").where(possible).select(*self.cols)
        return self.keys.read().join(hits, self.cols, "left_semi").distinct()

    def add(self, df: DataFrame, batch: str) -> bool:
        """Make the keys of ``df`` known as batch ``batch``; once, also if it is rerun."""
        keys = self._distinct(df)
        added = self.keys.load(keys, batch)
        self.filter.load(placed(keys, self.cols, self.blocks).groupBy("block").agg(*[F.bit_or(m).alias(m) for m in _MASKS]), batch)
        return added
