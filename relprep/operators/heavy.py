"""Joins that spread their heavy keys (JOIN-4, JOIN-6).

Adaptive execution splits a skewed partition on the side that a join may
repeat.  In an outer join it cannot split the side that supplies the nulls, and
a key that is heavy on both sides stays with one pair of tasks a split.
``heavy_join`` finds the keys that hold more than a share of either side in
one pass each and gives only those a grid: a left row goes to one of the
key's left parts, repeated for each of its right parts, and the other way
round, so each pair of rows meets in one cell.  All other keys have a
grid of one cell and are joined as always, in the same join.

The list of heavy keys is bounded by construction: at most 1 / ``share`` keys
of each side hold more than that share of its rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Parts of the rows that have no key.
_NO_KEY_PARTS = 4096


def heavy_keys(df: DataFrame, keys: list[str], share: float) -> DataFrame:
    """(keys, n) of the keys that hold more than ``share`` of the rows that have a key.

    The counts are pre-aggregated in each task.  There are at most 1 / share.
    """
    own = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    counts = own.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total")).select("total").scalar()
    return counts.where(F.col("n") > share * total)


def _spread(columns: list[str], parts: Column) -> Column:
    """A row's part: a function of the row and its input partition, the same on each retry of a task.

    Rows equal in every column stay together within an input partition, which bounds them.
    """
    return F.when(parts > 1, F.pmod(F.xxhash64(*columns, F.spark_partition_id()), parts)).otherwise(0).cast("int")


def heavy_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", share: float = 0.001, rows_per_part: int = 1_000_000) -> DataFrame:
    """``left.join(right, keys, how)`` for ``how`` inner or left, heavy keys spread over tasks.

    A heavy key's side is cut into parts of about ``rows_per_part`` rows.
    """
    if how not in ("inner", "left"):
        raise ValueError("inner and left joins only")
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    if clash:
        raise ValueError(f"rename columns that both sides have: {sorted(clash)}")
    heavy = []
    for side, df in (("l", left), ("r", right)):
        parts = F.greatest(F.lit(1), F.ceil(F.col("n") / rows_per_part)).cast("int")
        heavy.append(heavy_keys(df, keys, share).select(*keys, parts.alias(f"__{side}_parts")))
    grid = heavy[0].join(heavy[1], keys, "full").select(*keys, *[F.coalesce(c, F.lit(1)).alias(c) for c in ("__l_parts", "__r_parts")])
    grid = grid.where("__l_parts > 1 OR __r_parts > 1")
    # At most 2 / share rows by the definition of a heavy key.
    cells = grid.select(*keys, "__l_parts", "__r_parts")

    def placed(df: DataFrame, own: str, other: str) -> DataFrame:
        met = df.join(F.broadcast(cells), keys, "left")
        sizes = {s: F.coalesce(F.col(f"__{s}_parts"), F.lit(1)) for s in (own, other)}
        # Rows without a key meet nothing, so they may lie anywhere.
        no_key = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in keys])
        met = met.withColumn(f"__{own}", _spread(df.columns, F.when(no_key, F.lit(_NO_KEY_PARTS)).otherwise(sizes[own])))
        met = met.withColumn(f"__{other}", F.explode(F.sequence(F.lit(0), sizes[other] - 1)))
        return met.withColumn("__copies", sizes[other]).drop("__l_parts", "__r_parts")

    a = placed(left, "l", "r").withColumnRenamed("__copies", "__seen_as")
    b = placed(right, "r", "l").drop("__copies").withColumn("__met", F.lit(True))
    out = a.join(b, [*keys, "__l", "__r"], how)
    # A left row that has copies has a key that is heavy on the right, so it met some row there:
    # a copy without one is a cell that got no right row.
    out = out.where("__met OR __seen_as = 1")
    return out.select(*left.columns, *[c for c in right.columns if c not in keys])
