"""Grouped and global aggregates, and comparisons with a global aggregate (AGG-*).

Grouped aggregates are planned by Spark as partial (map-side) aggregation,
a hash shuffle on the grouping key, then the final aggregation, so a hot
key is pre-combined in every map task before it is shuffled.

A global aggregate used inside a per-row expression (``x > avg(x)``,
``max(x) - x``) is a scalar subquery (``DataFrame.scalar()``): Spark runs
it once as a separate job, broadcasts the single value inside the filter,
and never plans a nested-loop join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_by(df: DataFrame, keys: list[Column | str], counted: Column | str, alias: str = "n") -> DataFrame:
    """SELECT k, COUNT(col) ... GROUP BY k (AGG-1, AGG-2, AGG-3).

    ``COUNT(col)`` skips NULLs, so a NULL group shows 0.
    """
    return df.groupBy(*keys).agg(F.count(_c(counted)).alias(alias))


def sum_by(df: DataFrame, keys: list[Column | str], value: Column | str, alias: str = "total") -> DataFrame:
    """SELECT k, SUM(v) ... GROUP BY k (AGG-4)."""
    return df.groupBy(*keys).agg(F.sum(_c(value)).alias(alias))


def scalar(df: DataFrame, expr: Column) -> Column:
    """An uncorrelated scalar subquery ``(SELECT expr FROM df)``."""
    return df.agg(expr).scalar()


def int_avg(c: str) -> Column:
    """AVG over an integer column keeps the integer type and truncates (AGG-6).

    ``sum div count`` is exact integral division (no floating point).
    """
    return F.expr(f"sum(`{c}`) div count(`{c}`)")


def avg_of(df: DataFrame, c: str, integer: bool = False) -> Column:
    return scalar(df, int_avg(c) if integer else F.avg(c))


def above_average(df: DataFrame, c: str, integer: bool = False) -> DataFrame:
    """Rows whose ``c`` exceeds the average of ``c`` over ``df`` (AGG-8)."""
    return df.filter(F.col(c) > avg_of(df, c, integer))

