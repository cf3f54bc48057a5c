"""Tables that keep an order (SRT-1): sorted files with recorded bounds.

``INSERT ... SELECT ... ORDER BY`` into a plain table keeps no order.  Here the
rows are range-partitioned by the whole row (the order's columns first, so a
value that a third of the rows share spreads over several files), sorted in
each file, and one record a file says how many rows and which bounds it has.
A row's position is then its file's offset plus its place in the file: rows
come back in order, or a range of them from only the files that hold it,
without a sort or a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_BOUNDS = "_bounds"


def write_ordered(df: DataFrame, path: str, order_by: list[str], n_files: int | None = None, rows_per_file: int = 0) -> StructType:
    """Write ``df`` in the order of ``order_by`` (null first, ties by the other columns); returns its schema."""
    spark = df.sparkSession
    order = [F.col(c).asc_nulls_first() for c in [*order_by, *[c for c in df.columns if c not in order_by]]]
    place = F.monotonically_increasing_id()  # tells rows apart that are equal in every column
    n = n_files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.withColumn("__place", place).repartitionByRange(n, *order, F.col("__place")).sortWithinPartitions(*order, "__place").drop("__place")
    ranged.write.mode("errorifexists").option("maxRecordsPerFile", rows_per_file).parquet(path)
    key = F.struct(*order_by)
    stored = spark.read.schema(df.schema).parquet(path)
    bounds = stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
    # Files are named by partition, then by part: their names are in the rows' order.
    offset = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bounds.withColumn("offset", offset).write.mode("overwrite").parquet(f"{path}/{_BOUNDS}")
    return df.schema


def bounds(spark: SparkSession, path: str) -> DataFrame:
    """One row a file: file, n, lo, hi, offset."""
    return spark.read.parquet(f"{path}/{_BOUNDS}")


def read_positions(spark: SparkSession, path: str, schema: StructType, alias: str = "position") -> DataFrame:
    """The rows with their position from 1 on, by a scan and a join with one row a file."""
    stored = spark.read.schema(schema).parquet(path)
    at = stored.select(*schema.names, F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    offsets = bounds(spark, path).select(F.col("file").alias("__file"), "offset")  # one row a file
    return at.join(F.broadcast(offsets), "__file").select(*schema.names, (F.col("offset") + F.col("__row") + 1).alias(alias))


def _files(spark: SparkSession, path: str, lo: Any = None, hi: Any = None) -> list[str]:
    found = bounds(spark, path)
    first = found.schema["lo"].dataType.names[0]
    if hi is not None:
        found = found.where(F.col("lo")[first].isNull() | (F.col("lo")[first] <= F.lit(hi)))
    if lo is not None:
        found = found.where(F.col("hi")[first] >= F.lit(lo))
    return [f"{path}/{r.file}" for r in found.orderBy("file").select("file").collect()]  # one a file, not a row


def stream_ordered(spark: SparkSession, path: str, schema: StructType) -> Iterator[Row]:
    """All rows in order, a file at a time."""
    for file in _files(spark, path):
        yield from spark.read.schema(schema).parquet(file).select("*", F.col("_metadata.row_index").alias("__row")).sort("__row").drop("__row").toLocalIterator()


def between(spark: SparkSession, path: str, schema: StructType, lo: Any, hi: Any) -> DataFrame:
    """Rows whose first ordering column is in ``lo``..``hi``, from the files that hold such."""
    first = bounds(spark, path).schema["lo"].dataType.names[0]
    found = _files(spark, path, lo, hi)
    rows = spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)
    return rows.where(F.col(first).between(lo, hi))
