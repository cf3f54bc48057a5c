"""Sorts, top-n and ordered updates of the first n rows (SRT-*)."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relprep.functions.text import shuffle_key
from relprep.operators.keys import with_identity


def sort_report(df: DataFrame, *order: Column | str, unique: list[str]) -> DataFrame:
    """ORDER BY for a report (SRT-1, SRT-2), with unique tie-breakers.

    A global sort range-partitions on the sort key; if one value holds a
    third of the rows, all of them land in one partition.  Appending
    unique columns lets the range partitioner split equal values across
    tasks and makes the order deterministic.
    """
    return df.orderBy(*order, *unique)


def top_n(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """TOP(n) with an explicit order (SRT-4).

    Planned as ``TakeOrderedAndProject``: each task keeps its own n best
    rows and only n rows per task reach the final merge.
    """
    if not order:
        raise ValueError("top_n needs an ordering key; TOP without ORDER BY is arbitrary")
    return df.orderBy(*order).limit(n)


def assign_top_n(
    df: DataFrame,
    n: int,
    order: list[str],
    column: str,
    first: Column | Any,
    rest: Column | Any,
) -> DataFrame:
    """UPDATE TOP(n) SET column = first; UPDATE SET column = rest WHERE column IS NULL (SRT-5, UPD-2).

    The n smallest rows by ``order`` (NULL first, as T-SQL sorts), with all
    other columns as tie-breakers, are found as a top-n; only the largest of
    them reaches the driver, and every row is compared with it in one pass
    without a shuffle.  Where more rows than are due equal it in every column,
    just those are numbered: exactly n rows are updated whatever repeats, no
    row is multiplied, and nothing is joined back by a key.
    """
    first_c = first if isinstance(first, Column) else F.lit(first)
    rest_c = rest if isinstance(rest, Column) else F.lit(rest)
    current = F.col(column) if column in df.columns else F.lit(None)
    columns = [*order, *[c for c in df.columns if c not in order]]
    key = F.struct(*columns)

    def updated(rows: DataFrame, due: Column) -> DataFrame:
        return rows.withColumn(column, F.when(due, first_c).otherwise(F.coalesce(current, rest_c)))

    top = df.orderBy(*[F.col(c).asc_nulls_first() for c in columns]).limit(n).groupBy(*columns).agg(F.count(F.lit(1)).alias("__due"))
    last = top.orderBy(*[F.col(c).desc_nulls_last() for c in columns]).first()
    if last is None:
        return updated(df, F.lit(False))
    bound = F.struct(*[F.lit(last[c]).cast(df.schema[c].dataType).alias(c) for c in columns])
    equal = df.where(key.eqNullSafe(bound))
    if equal.count() == last["__due"]:
        return updated(df, key <= bound)
    numbered = updated(with_identity(equal, order, "__rank"), F.col("__rank") <= last["__due"]).drop("__rank")
    return updated(df.where(~key.eqNullSafe(bound)), key < bound).unionByName(numbered)


def keyed_shuffle(df: DataFrame, keys: list[str], salt: str, key_alias: str = "shuffle_key") -> DataFrame:
    """ORDER BY NEWID() in reproducible form (SRT-3): order by md5(keys | salt).

    The same salt gives the same order on every run and every retry.
    """
    return df.withColumn(key_alias, shuffle_key(*keys, salt=salt)).orderBy(key_alias)
