"""Aggregate reports: grouped and global aggregates, comparisons with a
global aggregate, HAVING, top-n (AGG-*, SRT-*, FLT-12, PRM-3/4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relprep.fixed import TOP_N
from relprep.functions import money as M
from relprep.functions.dates import year_diff
from relprep.functions.text import shuffle_key, tsql_len
from relprep.operators.aggregates import above_average, count_by, int_avg, scalar, sum_by
from relprep.operators.joins import lookup_key
from relprep.operators.keys import with_identity
from relprep.operators.search import any_match_above_avg
from relprep.operators.sorting import assign_top_n, sort_report, top_n
from relprep.plans import sqlfrag as S
from relprep.plans.common import order_lines
from relprep.plans.registry import check
from relprep.sources.tables import load

# ---- AGG-4/5/8/9: order totals, their average, orders above it ------------


def order_totals(spark: SparkSession, base: str) -> DataFrame:
    """view: order -> sum of its line totals (AGG-4)."""
    lines = order_lines(spark, base)
    return sum_by(lines, ["order_id"], "line_total", "total").withColumn("total", F.col("total").cast(M.MONEY_SUM))


SQL_ORDER_TOTALS = """
    SELECT l_orderkey AS order_id,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(19,4))) AS DECIMAL(38,4)) AS total
    FROM lineitem GROUP BY l_orderkey"""


@check("q_sum_per_order", SQL_ORDER_TOTALS, ("AGG-4", "MTH-1"))
def q_sum_per_order(spark: SparkSession, base: str) -> DataFrame:
    return order_totals(spark, base)


@check(
    "q_avg_of_sums",
    f"SELECT CAST(ROUND(AVG(total), 2) AS DECIMAL(38,2)) AS avg_total FROM ({SQL_ORDER_TOTALS})",
    ("AGG-5", "AGG-7", "MTH-4"),
)
def q_avg_of_sums(spark: SparkSession, base: str) -> DataFrame:
    return order_totals(spark, base).agg(F.round(F.avg("total"), 2).cast("decimal(38,2)").alias("avg_total"))


@check(
    "q_above_avg",
    f"""WITH s AS ({SQL_ORDER_TOTALS})
    SELECT order_id, total,
           CAST(total - (SELECT ROUND(AVG(total), 2) FROM s) AS DECIMAL(38,4)) AS gap
    FROM s WHERE total > (SELECT AVG(total) FROM s)""",
    ("AGG-8", "AGG-9", "MTH-4", "SRC-3"),
)
def q_above_avg(spark: SparkSession, base: str) -> DataFrame:
    totals = order_totals(spark, base)
    rounded_avg = scalar(totals, F.round(F.avg("total"), 2))
    return above_average(totals, "total").select(
        "order_id", "total", (F.col("total") - rounded_avg).cast(M.MONEY_SUM).alias("gap")
    )


# ---- AGG-1 / PRM-3: COUNT(col) per group --------------------------------------


@check(
    "q_count_by_category",
    """SELECT p_brand AS category, COUNT(p_brand) AS n_lines
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""",
    ("AGG-1", "PRM-3"),
)
def q_count_by_category(spark: SparkSession, base: str) -> DataFrame:
    # Pre-aggregate the fact side per part before the join: the join then
    # sees one row per part instead of one per order line.
    li = load(spark, base, "lineitem")
    per_part = li.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    p = load(spark, base, "part")
    j = per_part.join(p, per_part.l_partkey == p.p_partkey)
    counted = F.coalesce(F.sum(F.when(F.col("p_brand").isNotNull(), F.col("n"))), F.lit(0)).cast("long")
    return j.groupBy(F.col("p_brand").alias("category")).agg(counted.alias("n_lines"))


@check(
    "q_count_by_quality",
    """SELECT quality, COUNT(quality) AS n_docs
       FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id GROUP BY quality""",
    ("AGG-1", "JOIN-6"),
)
def q_count_by_quality(spark: SparkSession, base: str) -> DataFrame:
    d = load(spark, base, "documents").select("doc_id")
    lab = load(spark, base, "labels").select("doc_id", "quality")
    return count_by(d.join(lab, "doc_id", "left"), ["quality"], "quality", "n_docs")


# ---- AGG-3 / AGG-6 / AGG-8 / STR-6 / FLT-15: length histogram and its stats ----
# Check parameter: length bound of the histogram view (LEN(x) < bound).
LEN_BOUND = 50


def url_length_histogram(spark: SparkSession, base: str) -> DataFrame:
    pages = load(spark, base, "pages")
    n = tsql_len("url")
    return count_by(pages.filter(n < LEN_BOUND), [n.alias("url_len")], n, "n_urls")


SQL_LEN_HIST = f"""
    SELECT {S.tsql_len('url')} AS url_len, COUNT({S.tsql_len('url')}) AS n_urls
    FROM pages WHERE {S.tsql_len('url')} < {LEN_BOUND} GROUP BY {S.tsql_len('url')}"""


@check("q_len_histogram", SQL_LEN_HIST, ("AGG-3", "STR-6", "FLT-15"))
def q_len_histogram(spark: SparkSession, base: str) -> DataFrame:
    return url_length_histogram(spark, base)


@check(
    "q_len_stats",
    f"""SELECT MIN(n_urls) AS min_n, MAX(n_urls) AS max_n, CAST(SUM(n_urls) // COUNT(n_urls) AS BIGINT) AS avg_n
        FROM ({SQL_LEN_HIST})""",
    ("AGG-6", "AGG-7"),
)
def q_len_stats(spark: SparkSession, base: str) -> DataFrame:
    h = url_length_histogram(spark, base)
    return h.agg(F.min("n_urls").alias("min_n"), F.max("n_urls").alias("max_n"), int_avg("n_urls").alias("avg_n"))


@check(
    "q_len_above_avg",
    f"""WITH h AS ({SQL_LEN_HIST})
        SELECT url_len, n_urls FROM h WHERE n_urls > (SELECT SUM(n_urls) // COUNT(n_urls) FROM h)""",
    ("AGG-8",),
)
def q_len_above_avg(spark: SparkSession, base: str) -> DataFrame:
    return above_average(url_length_histogram(spark, base), "n_urls", integer=True)


# ---- AGG-7 / AGG-9 / FLT-3: orders per client, the maximum, the gap to it ------


def orders_per_client(spark: SparkSession, base: str) -> DataFrame:
    """view: client name -> COUNT(client name) over the loaded orders.

    The fact side is counted per client key before the join, so the join
    sees one row per client and a client holding a third of all orders is
    pre-combined in every map task.
    """
    o = load(spark, base, "orders")
    per_key = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    c = load(spark, base, "customer")
    j = per_key.join(c, per_key.o_custkey == c.c_custkey)
    counted = F.coalesce(F.sum(F.when(F.col("c_name").isNotNull(), F.col("n"))), F.lit(0)).cast("long")
    return j.groupBy(F.col("c_name").alias("client_name")).agg(counted.alias("n_orders"))


SQL_ORDERS_PER_CLIENT = """
    SELECT c_name AS client_name, COUNT(c_name) AS n_orders
    FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_name"""


@check("q_max_of_counts", f"SELECT MAX(n_orders) AS max_orders FROM ({SQL_ORDERS_PER_CLIENT})", ("AGG-7",))
def q_max_of_counts(spark: SparkSession, base: str) -> DataFrame:
    return orders_per_client(spark, base).agg(F.max("n_orders").alias("max_orders"))


@check(
    "q_gap_to_max",
    f"""WITH v AS ({SQL_ORDERS_PER_CLIENT})
        SELECT client_name, n_orders, (SELECT MAX(n_orders) FROM v) - n_orders AS gap
        FROM v WHERE n_orders <> (SELECT MAX(n_orders) FROM v)""",
    ("AGG-9", "FLT-3"),
)
def q_gap_to_max(spark: SparkSession, base: str) -> DataFrame:
    v = orders_per_client(spark, base)
    mx = scalar(v, F.max("n_orders"))
    return v.filter(F.col("n_orders") != mx).select("client_name", "n_orders", (mx - F.col("n_orders")).alias("gap"))


# ---- AGG-10 / SRT-2: HAVING on a count, sorted ----------------------------------


@check(
    "q_having_count",
    """SELECT o_orderkey AS order_id, c_name AS client_name, COUNT(p_name) AS n_products
       FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
       GROUP BY o_orderkey, c_name HAVING COUNT(p_name) > 2 ORDER BY n_products DESC""",
    ("AGG-10", "SRT-2", "JOIN-4"),
)
def q_having_count(spark: SparkSession, base: str) -> DataFrame:
    li = load(spark, base, "lineitem")
    p = load(spark, base, "part")
    per_order = (
        li.join(p, li.l_partkey == p.p_partkey)
        .groupBy("l_orderkey").agg(F.count("p_name").alias("n_products"))
        .filter(F.col("n_products") > 2)
    )
    o = load(spark, base, "orders")
    c = load(spark, base, "customer")
    j = per_order.join(o, per_order.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
    out = j.select(F.col("o_orderkey").alias("order_id"), F.col("c_name").alias("client_name"), "n_products")
    return sort_report(out, F.desc("n_products"), unique=["order_id"])


# ---- AGG-11 / AGG-10 / SRT-2: discount-aware sales per product --------------------
# Check parameter: sales threshold of the report.
SALES_THRESHOLD = 1_000_000


@check(
    "q_sales_having",
    f"""SELECT p_name AS product_name,
               CAST(ROUND(SUM({S.money('p_retailprice')} * CAST(l_quantity AS INTEGER)
                              * (1 - {S.money('l_discount')})), 2) AS DECIMAL(38,2)) AS total_sales
        FROM lineitem JOIN part ON l_partkey = p_partkey
        GROUP BY p_name
        HAVING SUM({S.money('p_retailprice')} * CAST(l_quantity AS INTEGER) * (1 - {S.money('l_discount')})) > {SALES_THRESHOLD}
        ORDER BY total_sales DESC""",
    ("AGG-11", "AGG-10", "SRT-2", "MTH-4"),
)
def q_sales_having(spark: SparkSession, base: str) -> DataFrame:
    # sum(price * qty * (1 - d)) = price * sum(qty * (1 - d)) per part, since
    # the unit price is a part attribute: aggregate the order lines per part
    # first, join the (much smaller) result to part, then group by name.
    lines = order_lines(spark, base)
    per_part = lines.groupBy("product_id").agg(M.discounted_units("quantity", "discount").alias("units"))
    p = load(spark, base, "part")
    j = per_part.join(p, per_part.product_id == p.p_partkey)
    sales = F.sum(M.money("p_retailprice") * F.col("units"))
    out = j.groupBy(F.col("p_name").alias("product_name")).agg(sales.alias("_sales"))
    out = out.filter(F.col("_sales") > SALES_THRESHOLD).select(
        "product_name", M.round_money("_sales", 2, M.DecimalType(38, 2)).alias("total_sales")
    )
    return sort_report(out, F.desc("total_sales"), unique=["product_name"])


# ---- AGG-14 / FLT-12: per client and product, sum of above-average prices --------

SQL_CLIENT_PRODUCT = f"""
    SELECT c_name AS client_name, p_name AS product_name,
           CAST(SUM({S.money('l_extendedprice')}) AS DECIMAL(38,4)) AS price_sum
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN part ON l_partkey = p_partkey
    WHERE {S.money('l_extendedprice')} > (SELECT AVG({S.money('l_extendedprice')}) FROM lineitem)
    GROUP BY c_name, p_name"""


def client_product_sums(spark: SparkSession, base: str) -> DataFrame:
    """view: (client, product) -> sum of line prices above the average line price."""
    lines = order_lines(spark, base)
    above = above_average(lines, "line_total")
    o = load(spark, base, "orders")
    c = load(spark, base, "customer")
    p = load(spark, base, "part")
    # Lines are summed per order and product, then per client and product,
    # by keys alone; names join one row for each pair and are regrouped.
    per_order = above.groupBy("order_id", "product_id").agg(F.sum("line_total").cast(M.MONEY_SUM).alias("_sum"))
    by_key = per_order.join(o.select("o_orderkey", "o_custkey"), per_order.order_id == F.col("o_orderkey"))
    by_key = by_key.groupBy("o_custkey", "product_id").agg(F.sum("_sum").cast(M.MONEY_SUM).alias("_sum"))
    named = by_key.join(p.select("p_partkey", "p_name"), F.col("product_id") == F.col("p_partkey"))
    named = named.join(c.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
    return named.groupBy(F.col("c_name").alias("client_name"), F.col("p_name").alias("product_name")).agg(
        F.sum("_sum").cast(M.MONEY_SUM).alias("price_sum")
    )


@check("q_group_above_avg_price", SQL_CLIENT_PRODUCT + " ORDER BY price_sum", ("AGG-14", "AGG-8", "AGG-4", "SRT-2"))
def q_group_above_avg_price(spark: SparkSession, base: str) -> DataFrame:
    return sort_report(client_product_sums(spark, base), "price_sum", unique=["client_name", "product_name"])


def _sql_above_avg_search(where: str) -> str:
    return f"""WITH v AS ({SQL_CLIENT_PRODUCT})
        SELECT client_name, product_name, price_sum FROM v
        WHERE price_sum > (SELECT AVG(price_sum) FROM v) AND ({where}) ORDER BY price_sum"""


@check(
    "q_optional_params_above_avg",
    _sql_above_avg_search("client_name = 'Customer#000000007'"),
    ("FLT-12", "PRM-1", "PRM-2"),
)
def q_optional_params_above_avg(spark: SparkSession, base: str) -> DataFrame:
    v = client_product_sums(spark, base)
    return any_match_above_avg(
        v, {"client_name": "Customer#000000007", "product_name": None, "price_sum": None}, "price_sum",
        ["price_sum", "client_name", "product_name"],
    )


@check(
    "q_optional_params_above_avg_product",
    _sql_above_avg_search("product_name = 'red plate'"),
    ("FLT-12", "PRM-1", "PRM-2"),
)
def q_optional_params_above_avg_product(spark: SparkSession, base: str) -> DataFrame:
    v = client_product_sums(spark, base)
    return any_match_above_avg(
        v, {"client_name": None, "product_name": "red plate", "price_sum": None}, "price_sum",
        ["price_sum", "client_name", "product_name"],
    )


# ---- AGG-12 / DAT-3: count of year-boundary differences under a bound -----------


@check(
    "q_count_within_years",
    """SELECT COUNT(year(l_shipdate) - year(o_orderdate)) AS n_dates
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       WHERE year(l_shipdate) - year(o_orderdate) <= 3""",
    ("AGG-12", "DAT-3"),
)
def q_count_within_years(spark: SparkSession, base: str) -> DataFrame:
    li = load(spark, base, "lineitem")
    o = load(spark, base, "orders")
    diff = year_diff("o_orderdate", "l_shipdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).filter(diff <= 3).agg(F.count(diff).alias("n_dates"))


# ---- SRT-4 / SRT-5 / JOIN-7 / UPD-2: top-n and the ordered two-step update -------
# The two city names looked up (the batch size TOP_N is a fixed value).
FIRST_CITY, REST_CITY = "NATION_3", "NATION_7"


@check(
    "q_top_n",
    f"SELECT c_custkey, c_name, c_nationkey FROM customer ORDER BY c_custkey LIMIT 10",
    ("SRT-4",),
)
def q_top_n(spark: SparkSession, base: str) -> DataFrame:
    c = load(spark, base, "customer").select("c_custkey", "c_name", "c_nationkey")
    return top_n(c, TOP_N, "c_custkey")


@check(
    "q_assign_top_n",
    f"""WITH top AS (SELECT c_custkey AS k FROM customer ORDER BY c_custkey LIMIT 10)
        SELECT c_custkey, c_name,
               CASE WHEN top.k IS NOT NULL THEN (SELECT n_nationkey FROM nation WHERE n_name = '{FIRST_CITY}')
                    ELSE (SELECT n_nationkey FROM nation WHERE n_name = '{REST_CITY}') END AS city_id
        FROM customer LEFT JOIN top ON c_custkey = top.k""",
    ("SRT-5", "JOIN-7", "UPD-2", "PRM-5"),
)
def q_assign_top_n(spark: SparkSession, base: str) -> DataFrame:
    c = load(spark, base, "customer").select("c_custkey", "c_name")
    n = load(spark, base, "nation")
    first = lookup_key(n, "n_name", FIRST_CITY, "n_nationkey")
    rest = lookup_key(n, "n_name", REST_CITY, "n_nationkey")
    out = assign_top_n(c, TOP_N, ["c_custkey"], "city_id", first, rest)
    return out.select("c_custkey", "c_name", "city_id")


# ---- SRT-3: reproducible random order -----------------------------------------
# Check parameter: salt of the reproducible shuffle.
SHUFFLE_SALT = "load-order"


@check(
    "q_random_order",
    f"""SELECT c_custkey, c_name, shuffle_key, row_number() OVER (ORDER BY shuffle_key) AS position
        FROM (SELECT c_custkey, c_name, {S.shuffle_key('c_custkey', salt=SHUFFLE_SALT)} AS shuffle_key FROM customer)""",
    ("SRT-3",),
)
def q_random_order(spark: SparkSession, base: str) -> DataFrame:
    """A loaded table keeps no order: each row carries its place in the random one, given by one range sort."""
    c = load(spark, base, "customer").select("c_custkey", "c_name")
    return with_identity(c.withColumn("shuffle_key", shuffle_key("c_custkey", salt=SHUFFLE_SALT)), ["shuffle_key"], "position")
