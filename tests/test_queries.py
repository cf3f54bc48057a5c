"""Every registered check query against its DuckDB oracle on the smoke data,
plus plan-shape checks (pushdown, no Python UDF, no nested-loop join)."""

import datetime as dt
import decimal
import hashlib

import duckdb
import pytest

import __spark_entry__ as E
from relprep.plans import CHECKS
from relprep.sources.tables import DRIVER_TABLES, table_path


def _norm(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, float):
        return format(decimal.Decimal(repr(round(v, 6))).normalize(), "f")
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck(smoke_dir):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(smoke_dir, t)}')")
    yield con
    con.close()


# The reference's own queries; the corpus operators have tests of their own.
ORACLE = {n: c.sql for n, c in CHECKS.items() if c.sql is not None}
QUERIES = {n: c.fn for n, c in CHECKS.items()}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, smoke_dir, duck, name):
    sdf = QUERIES[name](spark, smoke_dir)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(sdf.columns, srows) == _digest(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["order_id", "total", "gap"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_python_and_no_nested_loop(spark, smoke_dir, name):
    plan = QUERIES[name](spark, smoke_dir)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_scan_is_pruned_and_filter_pushed(spark, smoke_dir):
    df = QUERIES["q_star_filter"](spark, smoke_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(n_name), EqualTo(n_name,NATION_7)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_extendedprice:double>" in plan


def test_top_n_query_is_take_ordered(spark, smoke_dir):
    plan = QUERIES["q_top_n"](spark, smoke_dir)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


_TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "double": "DOUBLE",
               "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_column_types_match_oracle(spark, smoke_dir, duck, name):
    df = QUERIES[name](spark, smoke_dir)
    spark_types = {f.name: _TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString().upper()) for f in df.schema}
    rel = duck.sql(ORACLE[name])
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert spark_types == duck_types
