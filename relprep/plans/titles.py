"""The titles database as one connected flow (SNK-1, PRJ-6/7, SRT-5, UPD-1/2/10, JOIN-4/5, DQ-3).

Load authors, publishers, titles and the bridge into declared layouts with
their defaults, number the cities, give the first n authors one city and the
rest another, write e-mail addresses by the *assigned* city, and read the
five-way view over the updated authors.  Every step reads the table the step
before wrote.

Mapping: author -> customer (name cut at ``#``), author's city -> nation,
publisher -> supplier, title -> part (published by the smallest supplier that
delivers it; notes: the part's type, none for types that start with S), bridge
-> distinct pairs of client and part on order lines.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from relprep.fixed import DEFAULT_NOTES, MAIL_DOMAIN, TITLE_DEFAULT_NOTES
from relprep.functions import money as M
from relprep.functions.dates import as_date
from relprep.functions.predicates import like, not_like
from relprep.functions.text import concat_strict
from relprep.operators.joins import lookup_key
from relprep.operators.keys import with_identity
from relprep.operators.quality import fk_violations
from relprep.operators.sorting import assign_top_n
from relprep.operators.updates import add_column, email_rule, fill_null
from relprep.plans.registry import check
from relprep.session import scratch_path
from relprep.sources.sinks import append, materialize
from relprep.sources.tables import PUBLISHER_LAYOUT, load

_RECORD = [StructField("created", DateType(), False), StructField("modified", DateType(), True)]
AUTHOR_LAYOUT = StructType([
    StructField("author_id", StringType(), False),
    StructField("last_name", StringType(), False),
    StructField("first_name", StringType(), False),
    StructField("zip", StringType(), True),
    *_RECORD,
])
TITLE_LAYOUT = StructType([
    StructField("title_id", StringType(), False),
    StructField("publisher_id", StringType(), True),
    StructField("title", StringType(), False),
    StructField("price", M.MONEY, True),
    StructField("notes", StringType(), True),
    StructField("published", DateType(), False),
    *_RECORD,
])
BRIDGE_LAYOUT = StructType([StructField("author_id", StringType(), False), StructField("title_id", StringType(), False), *_RECORD])
CITY_LAYOUT = StructType([StructField("city_id", LongType(), False), StructField("city", StringType(), False), *_RECORD])

# Check parameter: the date the defaults take.
TODAY = dt.date(2024, 6, 30)


@dataclass(frozen=True)
class Variant:
    """What the two scripts do differently."""

    first_n: int
    first_city: str
    rest_city: str
    seed: int
    step: int
    with_notes_only: bool  # load titles WHERE notes IS NOT NULL, else all, notes omitted
    above_price: str
    publisher: str
    publisher_like: bool
    first_name_first: bool  # e-mail layout of the first city


SEPTEMBER_4 = Variant(10, "NATION_3", "NATION_7", 5, 5, False, "910", "%1%", True, True)
SEPTEMBER_18 = Variant(5, "NATION_9", "NATION_4", 1, 2, True, "905", "%2%", False, False)


#: The target tables, and those that the authors' updates need.
TABLES = ("authors", "publishers", "titles", "bridge", "cities")
AUTHOR_TABLES = ("authors", "cities")


def load_tables(spark: SparkSession, base: str, v: Variant, names: tuple[str, ...] = TABLES) -> dict[str, DataFrame]:
    """The target tables ``names``, written with their defaults and read back."""
    root = scratch_path(spark, "titles-db")
    record = {"created": F.lit(TODAY)}

    def insert(df: DataFrame, name: str, layout: StructType, **defaults) -> DataFrame:
        append(df, f"{root}/{name}", layout, record | defaults)
        return spark.read.schema(layout).parquet(f"{root}/{name}")

    c, n = load(spark, base, "customer"), load(spark, base, "nation")
    s, p = load(spark, base, "supplier"), load(spark, base, "part")
    o, li = load(spark, base, "orders"), load(spark, base, "lineitem")
    authors = c.select(
        F.col("c_custkey").cast("string").alias("author_id"),
        F.substring_index("c_name", "#", -1).alias("last_name"),
        F.substring_index("c_name", "#", 1).alias("first_name"),
    )
    publishers = s.select(F.col("s_suppkey").cast("string").alias("publisher_id"), F.col("s_name").alias("name"))
    published = li.groupBy("l_partkey").agg(F.min("l_suppkey").cast("string").alias("publisher_id"), as_date(F.min("l_shipdate")).alias("published"))
    titles = p.join(published, p.p_partkey == published.l_partkey).select(
        F.col("p_partkey").cast("string").alias("title_id"), "publisher_id", F.col("p_name").alias("title"),
        M.money("p_retailprice").alias("price"), F.when(not_like("p_type", "S%"), F.col("p_type")).alias("notes"), "published",
    )
    titles = titles.filter(F.col("notes").isNotNull()) if v.with_notes_only else titles.drop("notes")
    pairs = o.join(li, o.o_orderkey == li.l_orderkey).select(
        F.col("o_custkey").cast("string").alias("author_id"), F.col("l_partkey").cast("string").alias("title_id")
    )
    cities = c.join(n, c.c_nationkey == n.n_nationkey).select(F.col("n_name").alias("city")).distinct()
    inserts = {
        "authors": lambda: insert(authors, "authors", AUTHOR_LAYOUT),
        "publishers": lambda: insert(publishers, "publishers", PUBLISHER_LAYOUT, notes=DEFAULT_NOTES),
        "titles": lambda: insert(titles, "titles", TITLE_LAYOUT, notes=TITLE_DEFAULT_NOTES),
        "bridge": lambda: insert(pairs.distinct(), "bridge", BRIDGE_LAYOUT),
        "cities": lambda: insert(with_identity(cities, ["city"], "city_id", v.seed, v.step), "cities", CITY_LAYOUT),
    }
    return {name: inserts[name]() for name in names}


def updated_authors(spark: SparkSession, t: dict[str, DataFrame], v: Variant) -> DataFrame:
    """First n authors to one city, the rest to another, then e-mails by assigned city."""
    first = lookup_key(t["cities"], "city", v.first_city, "city_id")
    rest = lookup_key(t["cities"], "city", v.rest_city, "city_id")
    a = add_column(t["authors"], "city_id", "long")
    a = assign_top_n(a, v.first_n, ["author_id"], "city_id", first, rest)
    a = materialize(a, scratch_path(spark, "authors-cities"))
    one, two = ("first_name", "last_name") if v.first_name_first else ("last_name", "first_name")
    a = email_rule(add_column(a, "email", "string"), "email", "city_id", first, rest, one, two, MAIL_DOMAIN)
    return materialize(fill_null(a, "zip", "00000"), scratch_path(spark, "authors-mails"))


def authors_view(t: dict[str, DataFrame], authors: DataFrame, v: Variant) -> DataFrame:
    """The five-way view over the updated authors."""
    named = t["publishers"].select("publisher_id", F.col("name").alias("publisher"), F.col("notes").alias("publisher_notes"))
    kept = like("publisher", v.publisher) if v.publisher_like else not_like("publisher", v.publisher)
    titles = t["titles"].filter(F.col("price") > F.lit(v.above_price).cast(M.MONEY)).select("title_id", "publisher_id", "title", "price", F.col("notes").alias("title_notes"))
    city = t["cities"].filter(F.col("city") == v.first_city).select("city_id", "city")
    people = authors.join(city, "city_id").select("author_id", concat_strict(F.col("last_name"), " ", F.col("first_name")).alias("author"), "city", "email")
    # The assigned city keeps few authors, so the bridge meets them first.
    j = t["bridge"].select("author_id", "title_id").join(people, "author_id").join(titles, "title_id").join(named.filter(kept), "publisher_id")
    return j.select("author", "city", "email", "title", "price", "title_notes", "publisher", "publisher_notes")


def _sql_authors(n: int, first: str, rest: str, ids: str, first_mail: str, rest_mail: str) -> str:
    return f"""
    WITH cities AS (SELECT city, {ids} AS city_id FROM (SELECT city, row_number() OVER (ORDER BY city NULLS FIRST) AS r FROM
                      (SELECT DISTINCT n_name AS city FROM customer JOIN nation ON c_nationkey = n_nationkey))),
    authors AS (SELECT CAST(c_custkey AS VARCHAR) AS author_id, split_part(c_name, '#', 2) AS last_name, split_part(c_name, '#', 1) AS first_name FROM customer),
    placed AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY author_id NULLS FIRST, first_name NULLS FIRST, last_name NULLS FIRST) <= {n}
                              THEN (SELECT city_id FROM cities WHERE city = '{first}')
                              ELSE (SELECT city_id FROM cities WHERE city = '{rest}') END AS city_id FROM authors),
    mailed AS (SELECT author_id, last_name, first_name, city_id,
                      CASE WHEN city_id = (SELECT city_id FROM cities WHERE city = '{first}') THEN {first_mail} || '@fit.ba'
                           WHEN city_id = (SELECT city_id FROM cities WHERE city = '{rest}') THEN {rest_mail} || '@fit.ba' END AS email FROM placed)"""


_FIRST_LAST, _LAST_FIRST = "first_name || '.' || last_name", "last_name || '.' || first_name"
_SQL_4 = _sql_authors(10, "NATION_3", "NATION_7", "5 + 5 * (r - 1)", _FIRST_LAST, _LAST_FIRST)
_SQL_18 = _sql_authors(5, "NATION_9", "NATION_4", "1 + 2 * (r - 1)", _LAST_FIRST, _FIRST_LAST)
_SQL_AUTHOR_ROWS = """
    SELECT author_id, last_name, first_name, '00000' AS zip, city_id, email, DATE '2024-06-30' AS created, CAST(NULL AS DATE) AS modified FROM mailed"""


def _sql_view(city: str, notes: str, where: str) -> str:
    return f"""
    SELECT last_name || ' ' || first_name AS author, city, email, p_name AS title, CAST(p_retailprice AS DECIMAL(19,4)) AS price,
           {notes} AS title_notes, s_name AS publisher, 'Lorem ipsum' AS publisher_notes
    FROM mailed JOIN cities USING (city_id)
    JOIN (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS author_id, l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey) b USING (author_id)
    JOIN part ON p_partkey = b.l_partkey
    JOIN (SELECT l_partkey AS pk, min(l_suppkey) AS sk FROM lineitem GROUP BY l_partkey) pub ON pub.pk = p_partkey
    JOIN supplier ON s_suppkey = pub.sk
    WHERE city = '{city}' AND {where}"""


def _authors(spark: SparkSession, base: str, v: Variant) -> DataFrame:
    cols = ["author_id", "last_name", "first_name", "zip", "city_id", "email", "created", "modified"]
    return updated_authors(spark, load_tables(spark, base, v, AUTHOR_TABLES), v).select(*cols)


def _view(spark: SparkSession, base: str, v: Variant) -> DataFrame:
    t = load_tables(spark, base, v)
    return authors_view(t, updated_authors(spark, t, v), v)


@check("q_titles_authors_staged", _SQL_4 + _SQL_AUTHOR_ROWS, ("SNK-1", "SNK-3", "PRJ-6", "PRJ-7", "SRT-5", "UPD-1", "UPD-2", "UPD-10", "PRM-5", "JOIN-7"))
def q_titles_authors_staged(spark: SparkSession, base: str) -> DataFrame:
    return _authors(spark, base, SEPTEMBER_4)


@check("q_titles_authors_five_staged", _SQL_18 + _SQL_AUTHOR_ROWS, ("SNK-1", "SNK-3", "PRJ-6", "PRJ-7", "SRT-5", "UPD-1", "UPD-2", "UPD-10", "PRM-5"))
def q_titles_authors_five_staged(spark: SparkSession, base: str) -> DataFrame:
    """Five rows first, other cities, the e-mail layouts swapped."""
    return _authors(spark, base, SEPTEMBER_18)


@check(
    "q_titles_view_staged",
    _SQL_4 + _sql_view("NATION_3", "'The quick brown fox jumps over the lazy dog'", "CAST(p_retailprice AS DECIMAL(19,4)) > 910 AND s_name LIKE '%1%'"),
    ("JOIN-5", "PRM-4", "SNK-1", "PRJ-7", "FLT-7"),
)
def q_titles_view_staged(spark: SparkSession, base: str) -> DataFrame:
    return _view(spark, base, SEPTEMBER_4)


@check(
    "q_titles_view_noted_staged",
    _SQL_18 + _sql_view("NATION_9", "p_type", "p_type NOT LIKE 'S%' AND CAST(p_retailprice AS DECIMAL(19,4)) > 905 AND s_name NOT LIKE '%2%'"),
    ("JOIN-5", "PRM-4", "SNK-1", "FLT-6", "FLT-7"),
)
def q_titles_view_noted_staged(spark: SparkSession, base: str) -> DataFrame:
    return _view(spark, base, SEPTEMBER_18)


@check(
    "q_titles_bridge_orphans_staged",
    """SELECT CAST(l_partkey AS VARCHAR) AS title_id, COUNT(DISTINCT o_custkey) AS n_rows
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey
       WHERE o_custkey IS NOT NULL AND l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type NOT LIKE 'S%' AND p_partkey IS NOT NULL)
       GROUP BY l_partkey""",
    ("DQ-3", "SNK-1", "FLT-6"),
)
def q_titles_bridge_orphans_staged(spark: SparkSession, base: str) -> DataFrame:
    """The foreign-key check after the filtered load: bridge rows whose title was skipped for its notes."""
    t = load_tables(spark, base, SEPTEMBER_18, ("titles", "bridge"))
    bridge = t["bridge"].filter(F.col("author_id").isNotNull())
    return fk_violations(bridge, ["title_id"], t["titles"], ["title_id"])
