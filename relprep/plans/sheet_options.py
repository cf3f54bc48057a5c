"""The task sheets' rules where the scripts differ, and the orders load that has no script."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType

from relprep.fixed import CODE_LENGTH, MIN_PRODUCTS
from relprep.functions import money as M
from relprep.functions.dates import as_date, completed_years
from relprep.functions.text import concat_strict, date_text, digits_only, tsql_len, without_first, without_trailing
from relprep.operators.aggregates import above_average, scalar
from relprep.operators.sorting import sort_report
from relprep.operators.updates import add_column
from relprep.plans import sqlfrag as S
from relprep.plans.common import postcode
from relprep.plans.loads import ASOF, money_parts_view
from relprep.plans.registry import check
from relprep.plans.reports import SQL_ORDER_TOTALS, order_totals
from relprep.plans.rules import CARD_ORDER_VALUE
from relprep.session import scratch_path
from relprep.sources.sinks import append
from relprep.sources.tables import load

# ---- money: cents as an integer; the difference itself rounded -------------------


@check(
    "q_money_parts_sheet",
    """SELECT l_orderkey AS order_id, CAST((m - floor(m)) * 100 AS INTEGER) AS cents
       FROM (SELECT l_orderkey, CAST(l_extendedprice AS DECIMAL(19,4)) AS m FROM orders JOIN lineitem ON o_orderkey = l_orderkey)""",
    ("PRJ-8", "MTH-3"),
)
def q_money_parts_sheet(spark: SparkSession, base: str) -> DataFrame:
    return money_parts_view(spark, base).select("order_id", F.round("cents_part").cast("int").alias("cents"))


@check(
    "q_above_avg_sheet",
    f"""WITH s AS ({SQL_ORDER_TOTALS})
        SELECT order_id, CAST(ROUND(total - (SELECT CAST(AVG(total) AS DECIMAL(38,8)) FROM s), 2) AS DECIMAL(38,2)) AS gap
        FROM s WHERE total > (SELECT AVG(total) FROM s)""",
    ("AGG-8", "AGG-9", "MTH-4"),
)
def q_above_avg_sheet(spark: SparkSession, base: str) -> DataFrame:
    totals = order_totals(spark, base)
    gap = F.round(F.col("total") - scalar(totals, F.avg("total")), 2)
    return above_average(totals, "total").select("order_id", gap.cast("decimal(38,2)").alias("gap"))


# ---- text: card without its first four digits, hash without '=', digits of a phone ----


@check(
    "q_card_mail_view_sheet",
    f"""SELECT c_custkey AS person_id, substr(lpad(CAST(o_orderkey AS VARCHAR), 14, '0'), 5) AS new_card_number,
               rtrim(to_base64(unhex(sha256(c_name))), '=') AS new_mail_password,
               CAST(length(regexp_replace('1 (' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || ') 500 555-' || lpad(right(CAST(c_custkey AS VARCHAR), 4), 4, '0'), '[^0-9]', '', 'g')) AS INTEGER) AS phone_digits
        FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_totalprice > {CARD_ORDER_VALUE}""",
    ("STR-3", "STR-4", "STR-6"),
)
def q_card_mail_view_sheet(spark: SparkSession, base: str) -> DataFrame:
    c = load(spark, base, "customer")
    o = load(spark, base, "orders").filter(F.col("o_totalprice") > CARD_ORDER_VALUE)
    j = o.join(c, c.c_custkey == o.o_custkey)
    phone = concat_strict("1 (", F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), ") 500 555-", F.lpad(F.right(F.col("c_custkey").cast("string"), F.lit(4)), 4, "0"))
    return j.select(
        F.col("c_custkey").alias("person_id"),
        without_first(F.lpad(F.col("o_orderkey").cast("string"), 14, "0"), 4).alias("new_card_number"),
        without_trailing(F.base64(F.unhex(F.sha2("c_name", 256))), "=").alias("new_mail_password"),
        tsql_len(digits_only(phone)).alias("phone_digits"),
    )


# ---- the orders load: address, employee, hire date and years of service in one target ----

ORDERS_2019_LAYOUT = StructType([
    StructField("order_id", LongType(), False),
    StructField("buyer", StringType(), True),
    StructField("full_address", StringType(), True),
    StructField("order_date", DateType(), True),
    StructField("freight", M.MONEY, True),
    StructField("employee", StringType(), True),
    StructField("city", StringType(), True),
    StructField("hire_date", DateType(), True),
    StructField("years_of_service", IntegerType(), True),
    StructField("code", StringType(), True),
])

_SQL_LOAD = f"""
    SELECT o_orderkey AS order_id, c_name AS buyer,
           r_name || ' - ' || {S.postcode('c_custkey')} || ' - ' || n_name AS full_address,
           CAST(o_orderdate AS DATE) AS order_date, CAST(o_totalprice AS DECIMAL(19,4)) AS freight,
           split_part(s_name, '#', 2) || ' ' || split_part(s_name, '#', 1) AS employee, n_name AS city,
           hired AS hire_date,
           CAST(2024 - year(hired) - CASE WHEN 630 < month(hired) * 100 + day(hired) THEN 1 ELSE 0 END AS INTEGER) AS years_of_service,
           reverse(n_name || ' ' || left(CAST(hired AS VARCHAR), 10)) AS code
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    JOIN (SELECT l_orderkey, min(l_suppkey) AS sk FROM lineitem GROUP BY l_orderkey) e ON e.l_orderkey = o_orderkey
    JOIN supplier ON s_suppkey = sk
    JOIN (SELECT l_suppkey AS hk, CAST(min(l_shipdate) AS DATE) AS hired FROM lineitem GROUP BY l_suppkey) h ON h.hk = sk"""


def orders_2019(spark: SparkSession, base: str) -> DataFrame:
    """The loaded table: an order's employee is its smallest supplier, hired on its first delivery."""
    o, c, n = load(spark, base, "orders"), load(spark, base, "customer"), load(spark, base, "nation")
    r, s, li = load(spark, base, "region"), load(spark, base, "supplier"), load(spark, base, "lineitem")
    served = li.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("_sk"))
    hired = li.groupBy("l_suppkey").agg(as_date(F.min("l_shipdate")).alias("hire_date"))
    people = s.join(hired, s.s_suppkey == hired.l_suppkey).select("s_suppkey", "s_name", "hire_date")
    buyers = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    j = o.join(served, o.o_orderkey == served.l_orderkey).join(buyers, o.o_custkey == F.col("c_custkey")).join(people, F.col("_sk") == F.col("s_suppkey"))
    rows = j.select(
        F.col("o_orderkey").alias("order_id"), F.col("c_name").alias("buyer"),
        concat_strict(F.col("r_name"), " - ", postcode("c_custkey"), " - ", F.col("n_name")).alias("full_address"),
        as_date("o_orderdate").alias("order_date"), M.money("o_totalprice").alias("freight"),
        concat_strict(F.substring_index("s_name", "#", -1), " ", F.substring_index("s_name", "#", 1)).alias("employee"),
        F.col("n_name").alias("city"), "hire_date", completed_years("hire_date", ASOF).alias("years_of_service"),
    )
    code = F.reverse(concat_strict(F.col("city"), " ", F.left(date_text("hire_date"), F.lit(10))))
    path = scratch_path(spark, "orders-2019")
    append(add_column(rows, "code", "string", code), path, ORDERS_2019_LAYOUT)
    return spark.read.schema(ORDERS_2019_LAYOUT).parquet(path)


@check("q_orders_2019_staged", _SQL_LOAD, ("SNK-1", "SRC-2", "PRJ-1", "PRJ-11", "DAT-4", "STR-9", "JOIN-4"))
def q_orders_2019_staged(spark: SparkSession, base: str) -> DataFrame:
    return orders_2019(spark, base)


@check(
    "q_orders_2019_products_staged",
    f"""SELECT employee, code, COUNT(p_name) AS n_products
        FROM ({_SQL_LOAD}) x JOIN lineitem ON order_id = l_orderkey JOIN part ON l_partkey = p_partkey
        WHERE CAST(length(rtrim(code)) AS INTEGER) = 20 GROUP BY employee, code HAVING COUNT(p_name) > 2
        ORDER BY n_products DESC""",
    ("AGG-10", "SRT-2", "FLT-15", "PRM-4"),
)
def q_orders_2019_products_staged(spark: SparkSession, base: str) -> DataFrame:
    """The employee report over the loaded table: codes of 20 characters, more than two products."""
    kept = orders_2019(spark, base).filter(tsql_len("code") == CODE_LENGTH).select("order_id", "employee", "code")
    li, p = load(spark, base, "lineitem"), load(spark, base, "part")
    named = li.join(kept.select("order_id").distinct(), F.col("l_orderkey") == F.col("order_id"), "left_semi").join(p, li.l_partkey == p.p_partkey)
    per_order = named.groupBy("l_orderkey").agg(F.count("p_name").alias("_n"))
    out = kept.join(per_order, F.col("order_id") == F.col("l_orderkey")).groupBy("employee", "code").agg(F.sum("_n").alias("n_products"))
    return sort_report(out.filter(F.col("n_products") > MIN_PRODUCTS), F.desc("n_products"), unique=["employee", "code"])
