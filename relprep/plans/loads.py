"""Load, projection, filter and join checks (SRC-*, SNK-1/2, PRJ-*, FLT-*, JOIN-*)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relprep.fixed import DEFAULT_NOTES, DELIVERY_MAX_DAYS, NOTES_LENGTH, ROUND_UP_ABOVE_CENTS
from relprep.functions import money as M
from relprep.functions.dates import completed_years, day_diff, now, today
from relprep.functions.predicates import is_single_word, like, not_like, starts_with_digit
from relprep.functions.text import concat_strict, nvarchar, tsql_substring
from relprep.operators.aggregates import count_by
from relprep.operators.keys import with_identity
from relprep.operators.search import procedure
from relprep.operators.updates import add_column, week_bucket
from relprep.plans import sqlfrag as S
from relprep.plans.common import catalog, order_lines, orders_target, postcode
from relprep.plans.registry import check
from relprep.session import scratch_path
from relprep.sources.sinks import append, append_positional, materialize
from relprep.sources.tables import ORDERS_LAYOUT, PUBLISHER_LAYOUT, load

# ---- SRC-2 / PRJ-1 / JOIN-1: typed load of orders with their client ---------

SQL_ORDERS_TARGET = """
    SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date,
           CAST(o_totalprice AS DECIMAL(19,4)) AS total_price, c_custkey AS client_id,
           c_name AS client_name, c_mktsegment AS client_segment
    FROM customer JOIN orders ON c_custkey = o_custkey"""


@check("q_load_orders", SQL_ORDERS_TARGET, ("SRC-1", "SRC-2", "PRJ-1", "JOIN-1", "SNK-2"))
def q_load_orders(spark: SparkSession, base: str) -> DataFrame:
    """INSERT ... SELECT by position into the orders target, read back."""
    path = scratch_path(spark, "orders")
    append_positional(orders_target(spark, base), path, ORDERS_LAYOUT)
    return spark.read.schema(ORDERS_LAYOUT).parquet(path)


SQL_CATALOG = """
    SELECT p_partkey AS product_id, s_suppkey AS supplier_id, p_type AS unit,
           CAST(p_retailprice AS DECIMAL(19,4)) AS unit_price, p_brand AS category,
           s_name AS supplier_name
    FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) pairs
    JOIN part ON pairs.l_partkey = p_partkey
    JOIN supplier ON pairs.l_suppkey = s_suppkey"""


@check("q_catalog_load", SQL_CATALOG, ("JOIN-2", "JOIN-8", "AGG-13"))
def q_catalog_load(spark: SparkSession, base: str) -> DataFrame:
    return catalog(spark, base)


# ---- PRJ-2 / FLT-1 / MTH-1: line value for one discount -------------------


def _line_values(spark: SparkSession, base: str, discount: str) -> DataFrame:
    lines = order_lines(spark, base)
    part = load(spark, base, "part")
    kept = lines.filter(F.col("discount") == F.lit(discount).cast(M.MONEY))
    return kept.join(part, kept.product_id == part.p_partkey).select(
        "order_id", "product_id", M.line_value("p_retailprice", "quantity").alias("line_value")
    )


def _sql_line_values(discount: str) -> str:
    return f"""
    SELECT l_orderkey AS order_id, l_partkey AS product_id,
           CAST({S.money('p_retailprice')} * CAST(l_quantity AS INTEGER) AS DECIMAL(19,4)) AS line_value
    FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE {S.money('l_discount')} = {discount}"""


@check("q_line_value", _sql_line_values("0"), ("PRJ-2", "FLT-1", "MTH-1"))
def q_line_value(spark: SparkSession, base: str) -> DataFrame:
    return _line_values(spark, base, "0")


@check("q_line_value_b", _sql_line_values("0.05"), ("PRJ-2", "FLT-1", "MTH-1"))
def q_line_value_b(spark: SparkSession, base: str) -> DataFrame:
    return _line_values(spark, base, "0.05")


# ---- PRJ-3 / FLT-13 / MTH-2: integral quantity view ------------------------

SQL_INTEGRAL = f"""
    SELECT l_partkey AS product_id, p_brand AS category, {S.money('l_quantity')} AS unit_price,
           {S.money('l_extendedprice')} AS line_total,
           CAST({S.money('l_extendedprice')} / {S.money('l_quantity')} AS DECIMAL(19,4)) AS quantity
    FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE {S.money('l_extendedprice')} % {S.money('l_quantity')} = 0"""


def integral_view(spark: SparkSession, base: str) -> DataFrame:
    """view_kolicina: lines whose total divides evenly by the divisor (FLT-13)."""
    li = load(spark, base, "lineitem")
    part = load(spark, base, "part")
    kept = li.filter(M.is_integral_quotient("l_extendedprice", "l_quantity"))
    return kept.join(part, kept.l_partkey == part.p_partkey).select(
        F.col("l_partkey").alias("product_id"),
        F.col("p_brand").alias("category"),
        M.money("l_quantity").alias("unit_price"),
        M.money("l_extendedprice").alias("line_total"),
        M.safe_quotient("l_extendedprice", "l_quantity").alias("quantity"),
    )


@check("q_integral_quantity", SQL_INTEGRAL, ("PRJ-3", "FLT-13", "MTH-2"))
def q_integral_quantity(spark: SparkSession, base: str) -> DataFrame:
    return integral_view(spark, base)


# Check parameter: the as-of date of defaults and years of service.
ASOF = dt.date(2024, 6, 30)

# ---- SNK-1 / PRJ-7: insert with a column list, defaults for omitted columns --


@check(
    "q_insert_defaults",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS publisher_id, c_name AS name,
               'Lorem ipsum' AS notes, DATE '2024-06-30' AS created, CAST(NULL AS DATE) AS modified
        FROM customer""",
    ("SNK-1", "PRJ-7"),
)
def q_insert_defaults(spark: SparkSession, base: str) -> DataFrame:
    c = load(spark, base, "customer")
    src = c.select(F.col("c_custkey").cast("string").alias("publisher_id"), F.col("c_name").alias("name"))
    path = scratch_path(spark, "publishers")
    append(src, path, PUBLISHER_LAYOUT, {"notes": DEFAULT_NOTES, "created": F.lit(ASOF)})
    return spark.read.schema(PUBLISHER_LAYOUT).parquet(path)


# ---- PRJ-4: add an empty nullable column ------------------------------------


@check(
    "q_add_null_column",
    "SELECT p_partkey, p_name, p_type, CAST(NULL AS VARCHAR) AS password FROM part",
    ("PRJ-4",),
)
def q_add_null_column(spark: SparkSession, base: str) -> DataFrame:
    p = load(spark, base, "part").select("p_partkey", "p_name", "p_type")
    return add_column(p, "password", "string")


# ---- PRJ-5 / DAT-1: NOT NULL column filled with the current timestamp -------


@check(
    "q_add_timestamp_column",
    "SELECT o_orderkey, o_orderstatus, true AS has_timestamp, true AS same_day FROM orders",
    ("PRJ-5", "DAT-1"),
)
def q_add_timestamp_column(spark: SparkSession, base: str) -> DataFrame:
    """Every row gets the time of the statement; the clock's value itself is no result to compare."""
    o = load(spark, base, "orders").select("o_orderkey", "o_orderstatus")
    o = add_column(add_column(o, "modified_at", "timestamp", now()), "modified_on", "date", today())
    filled = F.col("modified_at").isNotNull() & F.col("modified_on").isNotNull()
    same = F.col("modified_at").cast("date") == F.col("modified_on")
    return o.select("o_orderkey", "o_orderstatus", filled.alias("has_timestamp"), same.alias("same_day"))


# ---- PRJ-6 / AGG-13: identity keys over distinct city names -----------------


def _cities(spark: SparkSession, base: str) -> DataFrame:
    c = load(spark, base, "customer")
    n = load(spark, base, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(F.col("n_name").alias("city")).distinct()


@check(
    "q_identity",
    """SELECT city,
              5 + 5 * (row_number() OVER (ORDER BY city NULLS FIRST) - 1) AS city_id_5_5,
              1 + 2 * (row_number() OVER (ORDER BY city NULLS FIRST) - 1) AS city_id_1_2
       FROM (SELECT DISTINCT n_name AS city FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
    ("PRJ-6", "AGG-13"),
)
def q_identity(spark: SparkSession, base: str) -> DataFrame:
    keyed = with_identity(_cities(spark, base), ["city"], "city_id_5_5", seed=5, step=5)
    return keyed.withColumn("city_id_1_2", F.expr("1 + 2 * ((city_id_5_5 - 5) div 5)"))


@check(
    "q_identity_orders",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST) AS order_seq
       FROM orders""",
    ("PRJ-6",),
)
def q_identity_orders(spark: SparkSession, base: str) -> DataFrame:
    """Dense ordered keys over a whole fact table: the parallel path of PRJ-6."""
    o = load(spark, base, "orders").select("o_orderkey", "o_orderdate")
    return with_identity(o, ["o_orderdate", "o_orderkey"], "order_seq").select("o_orderkey", "order_seq")


# ---- PRJ-8 / MTH-3: money split into whole part and cents -------------------

SQL_MONEY_PARTS = f"""
    SELECT l_orderkey AS order_id, o_custkey AS client_id,
           CAST(floor({S.money('l_extendedprice')}) AS DECIMAL(19,4)) AS whole_part,
           CAST(({S.money('l_extendedprice')} - floor({S.money('l_extendedprice')})) * 100 AS DECIMAL(19,4)) AS cents_part
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey"""


def money_parts_view(spark: SparkSession, base: str) -> DataFrame:
    lines = order_lines(spark, base)
    o = load(spark, base, "orders")
    j = o.join(lines, o.o_orderkey == lines.order_id)
    return j.select(
        "order_id",
        F.col("o_custkey").alias("client_id"),
        M.whole_part("line_total").alias("whole_part"),
        M.cents_part("line_total").alias("cents_part"),
    )


@check("q_money_parts", SQL_MONEY_PARTS, ("PRJ-8", "MTH-3", "JOIN-1"))
def q_money_parts(spark: SparkSession, base: str) -> DataFrame:
    return money_parts_view(spark, base)


SQL_ROUND_UP = f"""
    SELECT order_id, client_id, whole_part, cents_part,
           CAST(whole_part + 1 AS DECIMAL(19,4)) AS new_price
    FROM ({SQL_MONEY_PARTS}) WHERE cents_part > 49"""


def round_up_view(spark: SparkSession, base: str) -> DataFrame:
    v = money_parts_view(spark, base)
    return v.filter(F.col("cents_part") > ROUND_UP_ABOVE_CENTS).withColumn("new_price", M.rounded_up("whole_part", "cents_part"))


@check("q_ctas_round_up", SQL_ROUND_UP, ("PRJ-9", "SNK-3", "FLT-2"))
def q_ctas_round_up(spark: SparkSession, base: str) -> DataFrame:
    """SELECT ... INTO: the rounded prices are written as a new table and read back."""
    return materialize(round_up_view(spark, base), scratch_path(spark, "rounded-prices"))


# ---- PRJ-10: floor price on import (with quantity and discount) --------------


@check(
    "q_floor_price",
    f"""SELECT l_orderkey AS order_id, l_partkey AS product_id,
               CAST(floor({S.money('p_retailprice')}) AS DECIMAL(19,4)) AS product_price,
               CAST(l_quantity AS INTEGER) AS quantity, {S.money('l_discount')} AS discount
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    ("PRJ-10", "MTH-3"),
)
def q_floor_price(spark: SparkSession, base: str) -> DataFrame:
    lines = order_lines(spark, base)
    p = load(spark, base, "part")
    return lines.join(p, lines.product_id == p.p_partkey).select(
        "order_id", "product_id", M.floor_price("p_retailprice").alias("product_price"), "quantity", "discount"
    )


# ---- PRJ-11 / STR-1: composed labels, NULL-propagating ----------------------


@check(
    "q_compose_label",
    """SELECT c_custkey AS client_id,
              c_name || ' - ' || n_name || ' - ' || NULLIF(r_name, 'ASIA') AS full_address,
              split_part(c_name, '#', 2) || ' ' || split_part(c_name, '#', 1) AS employee
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ("PRJ-11", "STR-1"),
)
def q_compose_label(spark: SparkSession, base: str) -> DataFrame:
    c = load(spark, base, "customer")
    n = load(spark, base, "nation")
    r = load(spark, base, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.select(
        F.col("c_custkey").alias("client_id"),
        concat_strict(F.col("c_name"), " - ", F.col("n_name"), " - ", F.nullif("r_name", F.lit("ASIA"))).alias("full_address"),
        concat_strict(F.substring_index("c_name", "#", -1), " ", F.substring_index("c_name", "#", 1)).alias("employee"),
    )


# ---- FLT-7: LIKE patterns, case-sensitive and case-insensitive --------------


def _patterns(spark: SparkSession, base: str, contains: str, starts: str, ends: str, ci: bool) -> DataFrame:
    p = load(spark, base, "part").select("p_partkey", "p_name", "p_type")
    pred = like("p_name", f"%{contains}%", ci) & not_like("p_type", f"{starts}%", ci) & not_like("p_name", f"%{ends}", ci)
    return p.filter(pred)


@check(
    "q_name_patterns",
    "SELECT p_partkey, p_name, p_type FROM part WHERE p_name LIKE '%a%' AND p_type NOT LIKE 'S%' AND p_name NOT LIKE '%d'",
    ("FLT-7",),
)
def q_name_patterns(spark: SparkSession, base: str) -> DataFrame:
    return _patterns(spark, base, "a", "S", "d", False)


@check(
    "q_name_patterns_ci",
    "SELECT p_partkey, p_name, p_type FROM part WHERE p_name ILIKE '%B%' AND p_type NOT ILIKE 's%' AND p_name NOT ILIKE '%T'",
    ("FLT-7",),
)
def q_name_patterns_ci(spark: SparkSession, base: str) -> DataFrame:
    return _patterns(spark, base, "B", "s", "T", True)


# ---- FLT-8 / AGG-2: postcodes starting with a digit, counted ------------------


@check(
    "q_postcode_digits",
    f"""SELECT {S.postcode('s_suppkey')} AS postcode, COUNT({S.postcode('s_suppkey')}) AS n_products
        FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) pairs
        JOIN part ON pairs.l_partkey = p_partkey JOIN supplier ON pairs.l_suppkey = s_suppkey
        WHERE regexp_matches({S.postcode('s_suppkey')}, '^[0-9]')
        GROUP BY {S.postcode('s_suppkey')}""",
    ("FLT-8", "AGG-2"),
)
def q_postcode_digits(spark: SparkSession, base: str) -> DataFrame:
    cat = catalog(spark, base).withColumn("postcode", postcode("supplier_id"))
    return count_by(cat.filter(starts_with_digit("postcode")), ["postcode"], "postcode", "n_products")


# ---- FLT-14 / JOIN-3 / STR-10: one-word categories --------------------------


@check(
    "q_single_word",
    """SELECT o_orderkey AS order_id, c_name AS client_name, p_partkey AS product_id,
              o_orderpriority AS category, p_brand AS brand
       FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
       WHERE instr(o_orderpriority, ' ') = 0 AND instr(o_orderpriority, '/') = 0""",
    ("FLT-14", "JOIN-3", "STR-10"),
)
def q_single_word(spark: SparkSession, base: str) -> DataFrame:
    o = load(spark, base, "orders").filter(is_single_word("o_orderpriority"))
    c = load(spark, base, "customer")
    li = load(spark, base, "lineitem")
    p = load(spark, base, "part")
    j = o.join(c, o.o_custkey == c.c_custkey).join(li, o.o_orderkey == li.l_orderkey).join(p, li.l_partkey == p.p_partkey)
    return j.select(
        F.col("o_orderkey").alias("order_id"), F.col("c_name").alias("client_name"),
        F.col("p_partkey").alias("product_id"), F.col("o_orderpriority").alias("category"),
        F.col("p_brand").alias("brand"),
    )


# ---- JOIN-5 / FLT-2: six-way star with residual filters ---------------------


@check(
    "q_star_filter",
    """SELECT c_name AS client_name, n_name AS city, p_name AS title,
              CAST(l_extendedprice AS DECIMAL(19,4)) AS price, s_name AS publisher, o_orderpriority AS notes
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       WHERE l_extendedprice IS NOT NULL AND CAST(l_extendedprice AS DECIMAL(19,4)) > 10000
         AND s_name LIKE '%1%' AND n_name = 'NATION_7'""",
    ("JOIN-5", "FLT-2", "FLT-6", "FLT-7", "FLT-9"),
)
def q_star_filter(spark: SparkSession, base: str) -> DataFrame:
    # Without table statistics Spark keeps the written join order, so the
    # chain starts from the most selective filtered dimension (one nation)
    # and grows towards the fact table: the customer -> orders -> lineitem
    # joins then carry 1/25 of the rows instead of joining the whole fact
    # table first and filtering at the end.
    n = load(spark, base, "nation").filter(F.col("n_name") == "NATION_7")
    c = load(spark, base, "customer")
    o = load(spark, base, "orders")
    price = M.money("l_extendedprice")
    li = load(spark, base, "lineitem").filter(F.col("l_extendedprice").isNotNull() & (price > 10000))
    p = load(spark, base, "part")
    s = load(spark, base, "supplier").filter(like("s_name", "%1%"))
    j = (
        n.join(c, c.c_nationkey == n.n_nationkey)
        .join(o, o.o_custkey == c.c_custkey)
        .join(li, li.l_orderkey == o.o_orderkey)
        .join(s, li.l_suppkey == s.s_suppkey)
        .join(p, li.l_partkey == p.p_partkey)
    )
    return j.select(
        F.col("c_name").alias("client_name"), F.col("n_name").alias("city"), F.col("p_name").alias("title"),
        price.alias("price"), F.col("s_name").alias("publisher"), F.col("o_orderpriority").alias("notes"),
    )


# ---- JOIN-4: four-way chain ---------------------------------------------------


@check(
    "q_four_way",
    """SELECT o_orderkey AS order_id, c_name AS client_name, n_name AS nation, r_name AS region
       FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ("JOIN-4",),
)
def q_four_way(spark: SparkSession, base: str) -> DataFrame:
    o = load(spark, base, "orders")
    c = load(spark, base, "customer")
    n = load(spark, base, "nation")
    r = load(spark, base, "region")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.select(
        F.col("o_orderkey").alias("order_id"), F.col("c_name").alias("client_name"),
        F.col("n_name").alias("nation"), F.col("r_name").alias("region"),
    )


# ---- STR-5 / STR-13: text cut to NVARCHAR(100) and SUBSTRING(s, 0, 100) ---------


@check(
    "q_truncate_notes",
    f"""SELECT doc_id, substr(text, 1, 100) AS notes_100, substr(text, 1, 99) AS notes_0_100
        FROM documents""",
    ("STR-5", "STR-13"),
)
def q_truncate_notes(spark: SparkSession, base: str) -> DataFrame:
    d = load(spark, base, "documents")
    return d.select(
        "doc_id",
        nvarchar("text", NOTES_LENGTH).alias("notes_100"),
        tsql_substring("text", 0, NOTES_LENGTH).alias("notes_0_100"),
    )


# ---- DAT-2 / FLT-16 / FLT-4 / UPD-5 / PRM-4: delivery window and week buckets ------

SQL_DELIVERY = f"""
    SELECT p_partkey AS product_id, s_name AS supplier_name, n_name AS ship_city,
           CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days_to_ship
    FROM part JOIN lineitem ON p_partkey = l_partkey JOIN orders ON l_orderkey = o_orderkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    WHERE date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) <= 28"""


def delivery_view(spark: SparkSession, base: str) -> DataFrame:
    """view_isporuka: lines shipped within 28 days of the order (negatives included)."""
    li = load(spark, base, "lineitem")
    o = load(spark, base, "orders")
    s = load(spark, base, "supplier")
    c = load(spark, base, "customer")
    n = load(spark, base, "nation")
    p = load(spark, base, "part")
    # Orders are enriched with the client's city first (an orders-sized
    # join); the fact table is then joined once, on the order key, instead
    # of re-shuffling the fact-sized join output by client key.
    orders_city = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    j = li.join(orders_city, li.l_orderkey == o.o_orderkey).join(s, li.l_suppkey == s.s_suppkey)
    j = j.join(p, li.l_partkey == p.p_partkey)  # a line of an unknown product is no row of the view
    days = day_diff("o_orderdate", "l_shipdate")
    return j.filter(days <= DELIVERY_MAX_DAYS).select(
        F.col("p_partkey").alias("product_id"), F.col("s_name").alias("supplier_name"),
        F.col("n_name").alias("ship_city"), days.alias("days_to_ship"),
    )


@check("q_delivery_window", SQL_DELIVERY, ("DAT-2", "FLT-16", "JOIN-3", "PRM-4"))
def q_delivery_window(spark: SparkSession, base: str) -> DataFrame:
    return delivery_view(spark, base)


@check(
    "q_week_bucket",
    f"""SELECT week, COUNT(week) AS n_lines FROM (
          SELECT {S.week_case('days_to_ship')} AS week
          FROM ({SQL_DELIVERY})) GROUP BY week""",
    ("UPD-5", "FLT-4", "AGG-1", "PRM-4", "SRC-3"),
)
def q_week_bucket(spark: SparkSession, base: str) -> DataFrame:
    v = delivery_view(spark, base).withColumn("week", week_bucket("days_to_ship"))
    return count_by(v, ["week"], "week", "n_lines")


# ---- DAT-4: completed years since a date at a fixed as-of date -------------------

@check(
    "q_years_since",
    f"""SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date,
               CAST(year(DATE '{ASOF}') - year(o_orderdate)
                    - CASE WHEN month(DATE '{ASOF}') * 100 + day(DATE '{ASOF}')
                               < month(o_orderdate) * 100 + day(o_orderdate) THEN 1 ELSE 0 END AS INTEGER) AS years_since
        FROM orders""",
    ("DAT-4",),
)
def q_years_since(spark: SparkSession, base: str) -> DataFrame:
    o = load(spark, base, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("date").alias("order_date"),
        completed_years("o_orderdate", ASOF).alias("years_since"),
    )


# ---- JOIN-4 (shared key): four inputs joined on the client key -----------------


@check(
    "q_shared_key_join",
    """SELECT c_custkey, c_name, o_orderkey, n_orders, n_lines
       FROM customer JOIN orders ON o_custkey = c_custkey
       JOIN (SELECT o_custkey AS k1, COUNT(*) AS n_orders FROM orders GROUP BY o_custkey) a ON a.k1 = c_custkey
       JOIN (SELECT o_custkey AS k2, COUNT(*) AS n_lines
             FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey) b ON b.k2 = c_custkey""",
    ("JOIN-4", "AGG-4"),
)
def q_shared_key_join(spark: SparkSession, base: str) -> DataFrame:
    """Client, its orders, and two per-client aggregates, joined on the client
    key.  The aggregates meet the client first (one row a client on every
    side), and the orders are joined last, once: a client with a third of
    all orders is one row against many, which adaptive execution splits."""
    c = load(spark, base, "customer").select("c_custkey", "c_name")
    o = load(spark, base, "orders")
    li = load(spark, base, "lineitem")
    orders_per = o.groupBy(F.col("o_custkey").alias("k1")).agg(F.count(F.lit(1)).alias("n_orders"))
    lines_of = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_n"))
    lines_per = (
        o.join(lines_of, o.o_orderkey == lines_of.l_orderkey)
        .groupBy(F.col("o_custkey").alias("k2"))
        .agg(F.sum("_n").alias("n_lines"))
    )
    clients = c.join(orders_per, F.col("k1") == F.col("c_custkey")).join(lines_per, F.col("k2") == F.col("c_custkey"))
    j = o.select("o_custkey", "o_orderkey").join(clients, F.col("o_custkey") == F.col("c_custkey"))
    return j.select("c_custkey", "c_name", "o_orderkey", "n_orders", "n_lines")


@check(
    "q_count_integral_by_category",
    f"SELECT category, COUNT(category) AS n_lines FROM ({SQL_INTEGRAL}) GROUP BY category",
    ("AGG-1", "PRM-3", "PRM-4"),
)
def q_count_integral_by_category(spark: SparkSession, base: str) -> DataFrame:
    """Zero-argument report over the integral-quantity view: COUNT(category) per category."""
    return count_by(integral_view(spark, base), ["category"], "category", "n_lines")


# Check parameters: the arguments of the two procedure calls over the rounded prices.
ROUND_UP_ORDER, ROUND_UP_CLIENT = 10730, 1234


@check(
    "q_optional_params_round_up",
    f"""SELECT order_id, client_id, whole_part, cents_part, new_price FROM ({SQL_ROUND_UP})
        WHERE order_id = {ROUND_UP_ORDER} OR client_id = {ROUND_UP_CLIENT}""",
    ("FLT-10", "PRM-1", "PRM-2", "PRJ-9"),
)
def q_optional_params_round_up(spark: SparkSession, base: str) -> DataFrame:
    """The procedure over the rounded-price table, called with an order and a client."""
    proc = procedure(round_up_view(spark, base), ["order_id", "client_id", "whole_part", "cents_part", "new_price"])
    return proc(order_id=ROUND_UP_ORDER, client_id=ROUND_UP_CLIENT)
