"""Reading source tables and shaping them into declared layouts (SRC-1..3, PRJ-1).

``load`` returns a lazy scan: Catalyst prunes it to the referenced columns
and pushes filters into the Parquet reader, so callers never select
columns defensively.  ``typed`` casts and renames into a declared
``StructType`` in one projection (the ``INSERT ... SELECT`` shape).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from relprep.functions.money import MONEY

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(base: str, name: str) -> str:
    return f"{str(base).rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Read one source table (SRC-1).  ``base`` may be a local or remote URI.

    The schema comes from the files on every call, so a table that was
    rewritten with other columns is read as it is now.
    """
    return spark.read.parquet(table_path(base, name))


def load_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """Read a table of an external database (SRC-1, cross-database reads).

    Pass ``partitionColumn``/``lowerBound``/``upperBound``/``numPartitions``
    for a parallel read; without them JDBC reads in a single task.
    """
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options).load()


def typed(df: DataFrame, layout: StructType, mapping: dict[str, Column | str]) -> DataFrame:
    """Project ``df`` into ``layout``: each target column from ``mapping``,
    cast to the declared type, in declared order (SRC-2, PRJ-1).

    Target columns absent from ``mapping`` become typed NULLs.
    """
    cols = []
    for field in layout.fields:
        src = mapping.get(field.name)
        if src is None:
            expr = F.lit(None)
        else:
            expr = F.col(src) if isinstance(src, str) else src
        cols.append(expr.cast(field.dataType).alias(field.name))
    return df.select(*cols)


def tables(spark: SparkSession, base: str, *names: str) -> dict[str, DataFrame]:
    return {n: load(spark, base, n) for n in names}


# Declared target layouts used by the load steps (FIXTURES §2, mapped onto
# the driver tables).  Varchar lengths are checked by quality.length_violations.
ORDERS_LAYOUT = StructType([
    StructField("order_id", LongType(), False),
    StructField("order_date", DateType(), True),
    StructField("total_price", MONEY, True),
    StructField("client_id", LongType(), True),
    StructField("client_name", StringType(), True),
    StructField("client_segment", StringType(), True),
])

CATALOG_LAYOUT = StructType([
    StructField("product_id", LongType(), False),
    StructField("supplier_id", LongType(), False),
    StructField("unit", StringType(), True),
    StructField("unit_price", MONEY, True),
    StructField("category", StringType(), True),
    StructField("supplier_name", StringType(), True),
])

PUBLISHER_LAYOUT = StructType([
    StructField("publisher_id", StringType(), False),
    StructField("name", StringType(), False),
    StructField("notes", StringType(), True),
    StructField("created", DateType(), False),
    StructField("modified", DateType(), True),
])

# Varchar limits of the layouts above (DQ-6 input).
ORDERS_LENGTHS = {"client_name": 40, "client_segment": 15}
CATALOG_LENGTHS = {"unit": 20, "category": 15, "supplier_name": 40}
PUBLISHER_LENGTHS = {"publisher_id": 4, "name": 100, "notes": 1000}
