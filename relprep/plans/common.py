"""Shared derived tables ("views") over the driver tables.

Mapping of the reference's domain onto the driver tables:
order -> orders, product -> part, order line -> lineitem, supplier ->
supplier, client -> customer, city -> nation, country group -> region,
free text -> documents / pages, optional right side -> labels.

Each function returns a lazy DataFrame; Catalyst inlines it into every
query that uses it and prunes it to the columns that query reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relprep.functions import money as M
from relprep.functions.dates import as_date
from relprep.sources.tables import CATALOG_LAYOUT, ORDERS_LAYOUT, load, typed


def order_lines(spark: SparkSession, base: str) -> DataFrame:
    """Order lines with money typed once: line_total, discount as decimal(19,4)."""
    li = load(spark, base, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_quantity").cast("int").alias("quantity"),
        M.money("l_extendedprice").alias("line_total"),
        M.money("l_discount").alias("discount"),
        as_date("l_shipdate").alias("ship_date"),
    )


def orders_target(spark: SparkSession, base: str) -> DataFrame:
    """Orders joined with their client, typed into ORDERS_LAYOUT (SRC-2, PRJ-1, JOIN-1)."""
    o = load(spark, base, "orders")
    c = load(spark, base, "customer")
    joined = c.join(o, c.c_custkey == o.o_custkey, "inner")
    return typed(joined, ORDERS_LAYOUT, {
        "order_id": "o_orderkey",
        "order_date": as_date("o_orderdate"),
        "total_price": "o_totalprice",
        "client_id": "c_custkey",
        "client_name": "c_name",
        "client_segment": "c_mktsegment",
    })


def postcode(key: str):
    """Synthetic supplier postcode: first 6 hex digits of md5(key)."""
    return F.left(F.md5(F.col(key).cast("string")), F.lit(6))


def catalog(spark: SparkSession, base: str) -> DataFrame:
    """Product-supplier catalog (JOIN-2, JOIN-8): the distinct part/supplier
    pairs that occur on order lines, joined with both dimensions."""
    li = load(spark, base, "lineitem")
    p = load(spark, base, "part")
    s = load(spark, base, "supplier")
    pairs = li.select(F.col("l_partkey").alias("pk"), F.col("l_suppkey").alias("sk")).distinct()
    joined = pairs.join(p, pairs.pk == p.p_partkey).join(s, pairs.sk == s.s_suppkey)
    return typed(joined, CATALOG_LAYOUT, {
        "product_id": "p_partkey",
        "supplier_id": "s_suppkey",
        "unit": "p_type",
        "unit_price": "p_retailprice",
        "category": "p_brand",
        "supplier_name": "s_name",
    })
