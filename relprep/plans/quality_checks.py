"""Data-quality checks on the driver tables (DQ-1..7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relprep.functions.text import tsql_len
from relprep.operators.quality import (
    check_violations,
    fk_violations,
    length_violations,
    pk_violations,
    profile,
    unique_violations,
)
from relprep.plans import sqlfrag as S
from relprep.plans.common import catalog, orders_target
from relprep.fixed import DEFAULT_NOTES
from relprep.plans.loads import ASOF
from relprep.plans.registry import check
from relprep.sources.sinks import with_defaults
from relprep.sources.tables import CATALOG_LENGTHS, ORDERS_LENGTHS, PUBLISHER_LAYOUT, PUBLISHER_LENGTHS, load


@check(
    "q_dq_pk",
    """SELECT k AS account, COUNT(*) AS n_rows, CASE WHEN k IS NULL THEN 'null_key' ELSE 'duplicate' END AS reason
       FROM (SELECT CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal) AS BIGINT) END AS k FROM customer)
       GROUP BY k HAVING COUNT(*) > 1 OR k IS NULL""",
    ("DQ-1",),
)
def q_dq_pk(spark: SparkSession, base: str) -> DataFrame:
    """A key that is mostly unique, sometimes repeated and sometimes NULL: the whole balance."""
    account = F.when(F.col("c_acctbal") >= 0, F.floor("c_acctbal").cast("long"))
    return pk_violations(load(spark, base, "customer").select(account.alias("account")), ["account"])


@check(
    "q_dq_composite_pk",
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows,
              CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 'null_key' ELSE 'duplicate' END AS reason
       FROM lineitem GROUP BY l_orderkey, l_linenumber
       HAVING COUNT(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
    ("DQ-2",),
)
def q_dq_composite_pk(spark: SparkSession, base: str) -> DataFrame:
    return pk_violations(load(spark, base, "lineitem"), ["l_orderkey", "l_linenumber"])


@check(
    "q_dq_fk",
    """SELECT l_orderkey, COUNT(*) AS n_rows FROM lineitem
       WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL)
       GROUP BY l_orderkey""",
    ("DQ-3",),
)
def q_dq_fk(spark: SparkSession, base: str) -> DataFrame:
    return fk_violations(load(spark, base, "lineitem"), ["l_orderkey"], load(spark, base, "orders"), ["o_orderkey"])


@check(
    "q_dq_fk_labels",
    """SELECT doc_id, COUNT(*) AS n_rows FROM documents
       WHERE doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)
       GROUP BY doc_id""",
    ("DQ-3",),
)
def q_dq_fk_labels(spark: SparkSession, base: str) -> DataFrame:
    return fk_violations(load(spark, base, "documents"), ["doc_id"], load(spark, base, "labels"), ["doc_id"])


@check(
    "q_dq_unique",
    "SELECT p_name, COUNT(*) AS n_rows FROM part GROUP BY p_name HAVING COUNT(*) > 1",
    ("DQ-4",),
)
def q_dq_unique(spark: SparkSession, base: str) -> DataFrame:
    return unique_violations(load(spark, base, "part"), "p_name")


def _sql_profile(lengths: dict[str, int], source: str) -> str:
    parts = []
    for c, n in lengths.items():
        parts.append(
            f"""SELECT '{c}' AS "column", CAST(MAX({S.tsql_len(c)}) AS BIGINT) AS max_len,
                   COUNT(*) FILTER (WHERE {c} IS NULL) AS n_null,
                   COUNT(*) FILTER (WHERE {S.tsql_len(c)} > {n}) AS n_too_long
                FROM ({source})"""
        )
    return " UNION ALL ".join(parts)


_ORDERS_SOURCE = """SELECT c_name AS client_name, c_mktsegment AS client_segment
                    FROM customer JOIN orders ON c_custkey = o_custkey"""


@check(
    "q_dq_profile",
    _sql_profile(ORDERS_LENGTHS, _ORDERS_SOURCE)
    + """ UNION ALL SELECT 'ship_date' AS "column", CAST(NULL AS BIGINT) AS max_len,
          COUNT(*) FILTER (WHERE CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END IS NULL) AS n_null, CAST(NULL AS BIGINT) AS n_too_long
          FROM customer JOIN orders ON c_custkey = o_custkey""",
    ("DQ-5", "DQ-6"),
)
def q_dq_profile(spark: SparkSession, base: str) -> DataFrame:
    """Length limits of the loaded orders, and NOT NULL on a date that open orders lack."""
    o = load(spark, base, "orders").select(F.col("o_orderkey").alias("order_id"), F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")).alias("ship_date"))
    loaded = orders_target(spark, base).join(o, "order_id")
    return profile(loaded, ORDERS_LENGTHS, not_null=["ship_date"])


_PUBLISHER_SOURCE = f"""SELECT CAST(c_custkey AS VARCHAR) AS publisher_id, c_name AS name,
                              'Lorem ipsum' AS notes FROM customer"""


@check("q_dq_publisher_profile", _sql_profile(PUBLISHER_LENGTHS, _PUBLISHER_SOURCE), ("DQ-5", "DQ-6", "PRJ-7"))
def q_dq_publisher_profile(spark: SparkSession, base: str) -> DataFrame:
    """NVARCHAR limits of the publishers layout after the defaulted insert:
    numeric keys longer than 4 characters would not fit publisher_id."""
    c = load(spark, base, "customer")
    src = c.select(F.col("c_custkey").cast("string").alias("publisher_id"), F.col("c_name").alias("name"))
    loaded = with_defaults(src, PUBLISHER_LAYOUT, {"notes": DEFAULT_NOTES, "created": F.lit(ASOF)})
    return profile(loaded, PUBLISHER_LENGTHS)


_CATALOG_SOURCE = """SELECT p_type AS unit, p_brand AS category, s_name AS supplier_name
                     FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) pairs
                     JOIN part ON pairs.l_partkey = p_partkey JOIN supplier ON pairs.l_suppkey = s_suppkey"""


@check("q_dq_catalog_profile", _sql_profile(CATALOG_LENGTHS, _CATALOG_SOURCE), ("DQ-5", "DQ-6", "JOIN-8"))
def q_dq_catalog_profile(spark: SparkSession, base: str) -> DataFrame:
    return profile(catalog(spark, base), CATALOG_LENGTHS)


@check(
    "q_dq_length",
    f"""SELECT p_partkey, p_type FROM part WHERE {S.tsql_len('p_type')} > 6""",
    ("DQ-6",),
)
def q_dq_length(spark: SparkSession, base: str) -> DataFrame:
    p = load(spark, base, "part").select("p_partkey", "p_type")
    return length_violations(p, {"p_type": 6})


@check(
    "q_dq_check",
    f"""SELECT 'c_name' AS "column", COUNT(*) AS n_violations FROM customer WHERE NOT ({S.tsql_len('c_name')} = 18)
        UNION ALL
        SELECT 'p_name' AS "column", COUNT(*) AS n_violations FROM part WHERE NOT ({S.tsql_len('p_name')} = 10)""",
    ("DQ-7",),
)
def q_dq_check(spark: SparkSession, base: str) -> DataFrame:
    c = check_violations(load(spark, base, "customer"), tsql_len("c_name") == 18)
    p = check_violations(load(spark, base, "part"), tsql_len("p_name") == 10)
    return c.agg(F.count(F.lit(1)).alias("n_violations")).select(F.lit("c_name").alias("column"), "n_violations").unionByName(
        p.agg(F.count(F.lit(1)).alias("n_violations")).select(F.lit("p_name").alias("column"), "n_violations")
    )
