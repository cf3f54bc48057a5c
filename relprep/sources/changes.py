"""Change sets: UPDATE and DELETE that rewrite only the partitions they touch (UPD-1..11, DEL-1).

A rule of ``operators.updates`` is a function of the whole table.  Run over a
stored, partitioned table it would write every file again.  Here it runs in
two steps:

1. ``change_set`` applies the rule and keeps only the rows that it changes:
   a table of keys with their new values, read from the columns that the
   rule needs;
2. ``apply_changes`` rewrites the partitions that the changes name, and no
   other file: old rows whose key has a change go, new rows come.

The rewritten rows are written to scratch first and then put in place by
Spark's dynamic partition overwrite.  Changes say what a row is, not what to
add to it, so applying a change set again (after a driver was lost half-way)
gives the same table.  Keys are unique in a table, so no join here is skewed;
only the names of touched partitions reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from relprep.session import scratch_path
from relprep.sources import files
from relprep.sources.sinks import materialize

_WAS, _GONE = "__was", "__gone"


def write_partitioned(df: DataFrame, path: str, partition: str) -> StructType:
    """Write ``df`` as a table of one folder for each value of ``partition``; returns its schema."""
    df.write.mode("errorifexists").partitionBy(partition).parquet(path)
    return df.schema


def read_partitioned(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def change_set(
    table: DataFrame, partition: str, rule: Callable[[DataFrame], DataFrame] | None = None, delete: Column | None = None, repeated_keys: list[str] | None = None
) -> DataFrame:
    """The rows that ``rule`` (row by row) changes or ``delete`` matches, as changes.

    Columns: the table's with their new values, the partition that the row
    was in, and whether it is deleted.  ``delete`` is judged before the rule.
    Where keys may repeat or be null, ``repeated_keys`` names them: all rows
    of a key are then changes if one of them is.
    """
    row = F.struct(*[F.col(c).alias(c) for c in table.columns])
    gone = F.coalesce(delete, F.lit(False)) if delete is not None else F.lit(False)
    rows = table.withColumn(_GONE, gone).withColumn(_WAS, row)
    rows = rule(rows) if rule else rows
    changes = F.col(_GONE) | ~row.eqNullSafe(F.col(_WAS))
    out = rows.where(changes)
    if repeated_keys:
        names = [f"__key_{i}" for i in range(len(repeated_keys))]
        hit = out.select(*[F.col(k).alias(n) for k, n in zip(repeated_keys, names)]).distinct()
        out = rows.join(hit, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(repeated_keys, names)]), "left_semi")
    return out.select(*table.columns, F.col(_WAS)[partition].alias(_WAS), _GONE)


def inserts(rows: DataFrame, partition: str) -> DataFrame:
    """New rows as changes."""
    return rows.withColumn(_WAS, F.col(partition)).withColumn(_GONE, F.lit(False))


def _one_of(column: str, values: list) -> Column:
    known = [v for v in values if v is not None]
    preds = ([F.col(column).isin(known)] if known else []) + ([F.col(column).isNull()] if len(known) < len(values) else [])
    return reduce(lambda a, b: a | b, preds, F.lit(False))


def apply_changes(spark: SparkSession, path: str, schema: StructType, changes: DataFrame, keys: list[str], partition: str) -> list:
    """Rewrite the partitions that ``changes`` touches; returns their values.

    A row that changes its partition leaves the old one and comes to the new.
    """
    changes = materialize(changes, scratch_path(spark, "changes"))
    old, new = changes.select(F.col(_WAS).alias("v")), changes.where(f"NOT {_GONE}").select(F.col(partition).alias("v"))
    touched = [r.v for r in old.union(new).distinct().collect()]  # at most one a folder of the table
    if not touched:
        return []
    rows = read_partitioned(spark, path, schema)
    own = rows.where(_one_of(partition, touched))
    folders = own.select(F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1).alias("f")).distinct()
    before = {r.f for r in folders.collect()}
    # A row goes from where it was; and from where it comes to, if these changes were applied before.
    gone = changes.select(*keys, F.explode(F.array_distinct(F.array(_WAS, partition))).alias(partition))
    same = reduce(lambda a, b: a & b, [F.col(f"o.{k}").eqNullSafe(F.col(f"c.{k}")) for k in [*keys, partition]])
    kept = own.alias("o").join(gone.alias("c"), same, "left_anti")
    result = materialize(kept.unionByName(changes.where(f"NOT {_GONE}").select(*schema.names)), scratch_path(spark, "rewritten"))
    result.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    # A partition that has lost all its rows is not overwritten by anything.
    filled = [r.v for r in result.select(F.col(partition).alias("v")).distinct().collect()]
    if len(filled) < len(touched):
        now = read_partitioned(spark, path, schema).where(_one_of(partition, filled))
        left = now.select(F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1).alias("f")).distinct()
        for folder in before - {r.f for r in left.collect()}:
            files.remove(spark, folder)
    return touched
