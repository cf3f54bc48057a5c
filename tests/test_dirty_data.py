"""Every check query against its literal oracle on damaged copies of the smoke tables:
orphan keys, NULL keys, dates and names, repeated rows, and a third of the facts on one key."""

import duckdb
import pytest
from pyspark.sql import functions as F

from relprep.plans import CHECKS
from relprep.sources.tables import DRIVER_TABLES, table_path
from tests.test_queries import _digest

# A scalar lookup refuses repeated names by design, so dimensions keep unique ones.
NULLED = {
    "orders": {"o_orderdate": 11, "o_orderpriority": 13, "o_custkey": 17},
    "customer": {"c_acctbal": 7, "c_name": 19, "c_nationkey": 23},
    "lineitem": {"l_shipdate": 13, "l_partkey": 29, "l_orderkey": 31},
    "part": {"p_name": 11, "p_type": 13, "p_brand": 17},
    "documents": {"text": 11, "lang": 13},
    "labels": {"quality": 7},
    "pages": {"url": 7},
}
KEYS = {"orders": "o_orderkey", "customer": "c_custkey", "lineitem": "l_linenumber", "part": "p_partkey", "documents": "doc_id", "labels": "doc_id", "pages": "page_id"}


@pytest.fixture(scope="module")
def dirty(spark, smoke_dir, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("dirty"))
    for t in DRIVER_TABLES:
        df = spark.read.parquet(table_path(smoke_dir, t))
        if t == "part":
            df = df.where("p_partkey % 9 <> 4")  # lines without their product
        if t == "supplier":
            df = df.where("s_suppkey % 5 <> 3")
        if t == "customer":
            df = df.where("c_custkey % 8 <> 5")
        if t == "orders":
            df = df.where("o_orderkey % 10 <> 7").withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("o_custkey")))
        if t == "lineitem":
            df = df.where("l_orderkey % 12 <> 5").withColumn("l_partkey", F.when(F.col("l_orderkey") % 3 == 1, F.lit(2).cast("long")).otherwise(F.col("l_partkey")))
        for c, every in NULLED.get(t, {}).items():
            df = df.withColumn(c, F.when(F.pmod(F.xxhash64(*df.columns, F.lit(c)), F.lit(every)) != 0, F.col(c)))
        if t in ("lineitem", "labels", "pages"):
            df = df.union(df.where(F.pmod(F.xxhash64(*df.columns), F.lit(37)) == 0))  # repeated rows
        df.write.parquet(table_path(base, t))
    return base


@pytest.fixture(scope="module")
def duck(dirty):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(dirty, t)}/*.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(n for n in CHECKS if not n.endswith("_stream")))
def test_query_matches_oracle_on_damaged_tables(spark, dirty, duck, name):
    got = CHECKS[name].fn(spark, dirty)
    rows = [tuple(r) for r in got.collect()]
    result = duck.execute(CHECKS[name].sql)
    want = result.fetchall()
    cols = [d[0] for d in result.description]
    assert len(rows) == len(want)
    assert _digest(got.columns, rows) == _digest(cols, want)
