"""Write paths (SNK-1..4).

Every write goes through a Parquet folder; nothing is collected to the
driver.  ``stage`` writes to the shared checkpoint folder when the frame
holds non-deterministic columns, because a persisted frame can be
recomputed (and re-randomised) after an executor is lost.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from relprep.session import scratch_path


def with_defaults(df: DataFrame, layout: StructType, defaults: dict[str, Any] | None = None) -> DataFrame:
    """Shape ``df`` into ``layout`` for an insert with a column list (PRJ-7, SNK-1).

    Columns present in ``df`` are kept as they are, explicit NULLs included;
    only columns *omitted* from ``df`` take their default (or NULL).
    """
    defaults = defaults or {}
    present = set(df.columns)
    cols = []
    for f in layout.fields:
        if f.name in present:
            expr = F.col(f.name)
        elif f.name in defaults:
            d = defaults[f.name]
            expr = d if isinstance(d, Column) else F.lit(d)
        else:
            expr = F.lit(None)
        cols.append(expr.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def append(df: DataFrame, path: str, layout: StructType, defaults: dict[str, Any] | None = None) -> None:
    """INSERT INTO target (cols) SELECT ... (SNK-1): shape by name, then append."""
    with_defaults(df, layout, defaults).write.mode("append").parquet(path)


def append_positional(df: DataFrame, path: str, layout: StructType) -> None:
    """INSERT INTO target SELECT ... without a column list (SNK-2).

    Columns are matched by position and renamed/cast to the layout.
    """
    if len(df.columns) != len(layout.fields):
        raise ValueError(f"expected {len(layout.fields)} columns, got {len(df.columns)}")
    shaped = df.select(*[F.col(c).cast(f.dataType).alias(f.name) for c, f in zip(df.columns, layout.fields)])
    shaped.write.mode("append").parquet(path)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """SELECT ... INTO new_table (SNK-3): fails if the table exists, returns the re-read table."""
    df.write.mode("errorifexists").parquet(path)
    # The schema is known: supplying it skips the footer-reading inference job.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, name: str, deterministic: bool = True) -> DataFrame:
    """Session temp table ``#name`` (SNK-4).

    Deterministic frames are registered as a temp view over the lazy plan
    (Catalyst inlines it).  Frames with random columns are written once to
    the shared checkpoint folder and re-read, so every later read sees the
    same values.
    """
    if not deterministic:
        df = materialize(df, scratch_path(df.sparkSession, name))
    df.createOrReplaceTempView(name)
    return df
