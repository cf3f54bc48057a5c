"""Join helpers (JOIN-*).

Join strategy is left to Spark: a side whose estimated size is under
``spark.sql.autoBroadcastJoinThreshold`` is broadcast, anything larger is
shuffled and sort-merged, and AQE re-checks both decisions with runtime
sizes and splits skewed partitions.  No helper here forces a broadcast of
a side whose size is not bounded.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def lookup_key(dim: DataFrame, name_col: str, value: Any, key_col: str) -> Column:
    """``(SELECT key FROM dim WHERE name = value)`` as a scalar subquery (JOIN-7).

    A missing name gives NULL; two matching rows raise at run time, as in
    SQL.  Run ``quality.unique_violations(dim, name_col)`` first.
    """
    return dim.filter(F.col(name_col) == F.lit(value)).select(key_col).scalar()


def left_join_default(left: DataFrame, right: DataFrame, on: Column | str | list, fill: dict[str, Any], how: str = "left") -> DataFrame:
    """Left outer join, then ISNULL(col, default) on the given columns (JOIN-6, STR-15)."""
    out = left.join(right, on, how)
    for c, v in fill.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out
