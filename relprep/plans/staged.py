"""End-to-end flows that write their intermediate tables (SNK-1..3, PRM-4/5).

Each flow loads target tables with INSERT ... SELECT semantics, builds a
view over them, materialises it (SELECT ... INTO), then runs the ordered
update steps and a report.  Intermediate tables are written under the
shared checkpoint folder (``spark.checkpoint.dir``): a written table cuts
the lineage, so a lost executor recomputes from the last table instead of
from the sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from relprep.fixed import (
    DELIVERY_MAX_DAYS,
    ORDER_NO_TOKEN_LENGTH,
    STORE_FILL_RULES,
    TRIM_BELOW,
    TRIM_LENGTH,
    TRIM_START,
)
from relprep.functions import money as M
from relprep.functions.dates import as_date, day_diff
from relprep.functions.text import keyed_token, tsql_len
from relprep.operators.aggregates import above_average, count_by
from relprep.operators.updates import add_column, fill_from_key, fill_null, trim_prefix, week_bucket
from relprep.plans import sqlfrag as S
from relprep.plans.registry import check
from relprep.session import scratch_path
from relprep.sources.sinks import (
    append,
    append_positional,
    materialize,
    with_defaults,
)
from relprep.sources.tables import load

# ---- Flow A: products, orders, order lines -> delivery view -> week report -----

PRODUCT_LAYOUT = StructType([
    StructField("product_id", LongType(), False),
    StructField("unit_price", M.MONEY, True),
    StructField("category", StringType(), True),
    StructField("unit", StringType(), True),
])
ORDER_LAYOUT = StructType([
    StructField("order_id", LongType(), False),
    StructField("order_date", DateType(), True),
    StructField("ship_date", DateType(), True),
    StructField("ship_city", StringType(), True),
    StructField("client_id", LongType(), True),
    StructField("client_name", StringType(), True),
])
ORDER_PRODUCT_LAYOUT = StructType([
    StructField("order_id", LongType(), False),
    StructField("product_id", LongType(), False),
    StructField("line_value", M.MONEY, True),
])

# Check parameter: the discount of the loaded order lines.
LOADED_DISCOUNT = "0.05"


def _ship_dates(spark: SparkSession, base: str) -> DataFrame:
    li = load(spark, base, "lineitem")
    return li.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("_ship"))


def load_order_tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """INSERT ... SELECT into the three target tables; returns them re-read.

    Plain tables: the view's join on ``order_id`` is shuffled, its task
    count follows the data, and adaptive execution splits a hot order.
    """
    root = scratch_path(spark, "orders-db")
    p = load(spark, base, "part")
    append_positional(
        p.select("p_partkey", "p_retailprice", "p_brand", "p_type"), f"{root}/products", PRODUCT_LAYOUT
    )
    o = load(spark, base, "orders")
    c = load(spark, base, "customer")
    n = load(spark, base, "nation")
    j = o.join(_ship_dates(spark, base), o.o_orderkey == F.col("l_orderkey"), "left").join(
        c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    loaded = with_defaults(
        j.select(
            F.col("o_orderkey").alias("order_id"), as_date("o_orderdate").alias("order_date"),
            F.when(F.col("o_orderstatus") != "O", as_date("_ship")).alias("ship_date"),
            F.col("n_name").alias("ship_city"), F.col("c_custkey").alias("client_id"),
        ),
        ORDER_LAYOUT,
        # client_name is omitted from the insert and takes its default
        {"client_name": "unknown"},
    )
    li = load(spark, base, "lineitem")
    lines = li.filter(M.money("l_discount") == F.lit(LOADED_DISCOUNT).cast(M.MONEY))
    lines = lines.join(p, lines.l_partkey == p.p_partkey).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        M.line_value("p_retailprice", "l_quantity").alias("line_value"),
    )
    orders = materialize(loaded, f"{root}/orders")
    order_products = materialize(lines, f"{root}/order_products")
    products = spark.read.schema(PRODUCT_LAYOUT).parquet(f"{root}/products")
    return {"products": products, "orders": orders, "order_products": order_products}


def delivery_weeks(spark: SparkSession, base: str) -> DataFrame:
    t = load_order_tables(spark, base)
    pr, op, od = t["products"], t["order_products"], t["orders"]
    days = day_diff("order_date", "ship_date")
    view = (
        op.join(od, "order_id").join(pr, "product_id")
        .filter(days <= DELIVERY_MAX_DAYS)
        .select("product_id", "category", "ship_city", days.alias("days_to_ship"))
    )
    delivered = materialize(view, scratch_path(spark, "delivery"))  # SELECT ... INTO
    weeks = add_column(delivered, "week", "string").withColumn("week", week_bucket("days_to_ship"))
    return count_by(weeks, ["week"], "week", "n_lines")


@check(
    "q_delivery_weeks_staged",
    f"""WITH ships AS (SELECT l_orderkey, max(l_shipdate) AS ship FROM lineitem GROUP BY l_orderkey),
        od AS (SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date,
                      CASE WHEN o_orderstatus <> 'O' THEN CAST(ship AS DATE) END AS ship_date
               FROM orders LEFT JOIN ships ON o_orderkey = l_orderkey
               JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
        op AS (SELECT l_orderkey AS order_id, l_partkey AS product_id FROM lineitem JOIN part ON l_partkey = p_partkey
               WHERE {S.money('l_discount')} = {LOADED_DISCOUNT}),
        v AS (SELECT date_diff('day', order_date, ship_date) AS d
              FROM part JOIN op ON p_partkey = op.product_id JOIN od ON op.order_id = od.order_id
              WHERE date_diff('day', order_date, ship_date) <= 28)
        SELECT week, COUNT(week) AS n_lines FROM (
          SELECT {S.week_case('d')} AS week
          FROM v) GROUP BY week""",
    ("SNK-1", "SNK-2", "SNK-3", "PRJ-7", "DAT-2", "FLT-16", "UPD-5", "PRM-4", "PRM-5", "JOIN-3"),
)
def q_delivery_weeks_staged(spark: SparkSession, base: str) -> DataFrame:
    return delivery_weeks(spark, base)


# ---- Flow B: orders with order numbers and stores -> ordered updates -> lengths -----
CARD_ORDER_LAYOUT = StructType([
    StructField("order_id", LongType(), False),
    StructField("order_no", StringType(), True),
    StructField("store_id", LongType(), True),
])
# Check parameter: salt of the order-number token (7a).
SALT_ORDER_NO = "order-no"


def updated_card_orders(spark: SparkSession, base: str) -> DataFrame:
    """Load, then 7a fill NULL order numbers -> 7b/7c stores from the key ->
    8 trim short order numbers; the updated table is written once."""
    root = scratch_path(spark, "card-db")
    o = load(spark, base, "orders")
    c = load(spark, base, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    append(
        j.select(
            F.col("o_orderkey").alias("order_id"),
            F.when(F.col("o_orderstatus") != "O", F.col("o_orderpriority")).alias("order_no"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("store_id"),
        ),
        f"{root}/orders", CARD_ORDER_LAYOUT,
    )
    t = spark.read.schema(CARD_ORDER_LAYOUT).parquet(f"{root}/orders")
    t = (
        t.transform(lambda df: fill_null(
            df, "order_no", keyed_token("order_id", salt=SALT_ORDER_NO, length=ORDER_NO_TOKEN_LENGTH)))
        .transform(lambda df: fill_from_key(df, "store_id", "order_id", STORE_FILL_RULES))
        .transform(lambda df: trim_prefix(df, "order_no"))
    )
    return materialize(t, f"{root}/orders_updated")


_SQL_CARD_ORDERS = f"""
    WITH loaded AS (
        SELECT o_orderkey AS order_id, CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS order_no,
               CAST(CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS BIGINT) AS store_id
        FROM orders JOIN customer ON o_custkey = c_custkey),
    filled AS (
        SELECT order_id, COALESCE(order_no, {S.token('order_id', salt=SALT_ORDER_NO, length=25)}) AS order_no,
               {S.fill_from_key_case('store_id', 'order_id')} AS store_id
        FROM loaded)
    SELECT order_id,
           CASE WHEN {S.tsql_len('order_no')} < 25 THEN substr(order_no, 3, 22)
                ELSE order_no END AS order_no,
           store_id
    FROM filled"""


@check("q_order_numbers_staged", _SQL_CARD_ORDERS, ("SNK-1", "SNK-3", "UPD-2", "UPD-6", "UPD-8", "PRM-5"))
def q_order_numbers_staged(spark: SparkSession, base: str) -> DataFrame:
    return updated_card_orders(spark, base)


@check(
    "q_order_number_lengths_staged",
    f"""WITH h AS (SELECT {S.tsql_len('order_no')} AS no_len, COUNT({S.tsql_len('order_no')}) AS n_orders
                   FROM ({_SQL_CARD_ORDERS}) WHERE {S.tsql_len('order_no')} < 25
                   GROUP BY {S.tsql_len('order_no')})
        SELECT no_len, n_orders FROM h WHERE n_orders > (SELECT SUM(n_orders) // COUNT(n_orders) FROM h)""",
    ("AGG-3", "AGG-6", "AGG-8", "FLT-15", "SNK-3"),
)
def q_order_number_lengths_staged(spark: SparkSession, base: str) -> DataFrame:
    t = updated_card_orders(spark, base)
    n = tsql_len("order_no")
    hist = count_by(t.filter(n < TRIM_BELOW), [n.alias("no_len")], n, "n_orders")
    return above_average(hist, "n_orders", integer=True)
