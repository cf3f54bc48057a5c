"""Change sets, maintained views, ordered tables, keys across loads, foreign keys by blocks."""

import collections
import os

import pytest
from pyspark.sql import functions as F

from relprep.functions import money as M
from relprep.operators.known_keys import KnownKeys, blocks_for
from relprep.operators.maintained import MaintainedView
from relprep.operators.quality import fk_violations, fk_violations_by_blocks
from relprep.operators.updates import fill_null, trim_prefix, update
from relprep.session import scratch_path
from relprep.sources import files, ordered
from relprep.sources.changes import apply_changes, change_set, inserts, read_partitioned, write_partitioned
from relprep.sources.tables import load


def held(df):
    return sorted(map(str, df.collect()))


def local(path):
    return path.removeprefix("file:")


def stored_files(path):
    out = {}
    for folder, _, names in os.walk(local(path)):
        for n in names:
            if n.endswith(".parquet"):
                out[f"{os.path.basename(folder)}/{n}"] = os.stat(f"{folder}/{n}").st_mtime_ns
    return out


@pytest.fixture()
def orders(spark, smoke_dir):
    o = load(spark, smoke_dir, "orders")
    path = scratch_path(spark, "changed-orders")
    rows = o.select(
        "o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, None).otherwise(F.col("o_orderpriority")).alias("no"), F.col("o_orderstatus").alias("status")
    )
    return path, write_partitioned(rows, path, "status"), rows


def test_only_touched_partitions_are_rewritten(spark, orders):
    path, schema, rows = orders
    before = stored_files(path)

    def rule(df):
        return df.transform(lambda d: update(d, F.col("status") == "P", {"no": F.coalesce("no", F.lit("none"))})).transform(
            lambda d: update(d, (F.col("status") == "P") & (F.length("no") > 6), {"no": F.upper("no")}))

    changes = change_set(read_partitioned(spark, path, schema), "status", rule)
    assert apply_changes(spark, path, schema, changes, ["o_orderkey"], "status") == ["P"]
    assert held(read_partitioned(spark, path, schema)) == held(rule(rows))
    after = stored_files(path)
    kept = {k for k in before if not k.startswith("status=P")}
    assert kept and all(after.get(k) == before[k] for k in kept) and not any(k in after for k in before if k not in kept)


def test_changes_applied_twice_deletes_moves_and_inserts(spark, orders):
    path, schema, rows = orders
    table = read_partitioned(spark, path, schema)
    new = spark.createDataFrame([(-1, "new", "F"), (-2, None, None)], schema)
    deleted = (F.col("o_orderkey") % 3 == 0) | (F.col("status") == "P")

    def rule(df):
        return trim_prefix(fill_null(df, "no", "0123456789"), "no").withColumn("status", F.when(F.col("o_orderkey") % 7 == 0, "F").otherwise(F.col("status")))

    changes = change_set(table, "status", rule, delete=deleted).unionByName(inserts(new, "status"))
    want = held(rule(rows.where(~deleted)).unionByName(new))
    changes = spark.createDataFrame(changes.collect(), changes.schema)  # as the table was
    for _ in range(2):
        apply_changes(spark, path, schema, changes, ["o_orderkey"], "status")
        assert held(read_partitioned(spark, path, schema)) == want
    assert "status=P" not in files.names(spark, path)


def test_no_changes_touch_nothing(spark, orders):
    path, schema, rows = orders
    before = stored_files(path)
    assert apply_changes(spark, path, schema, change_set(rows, "status", lambda d: d), ["o_orderkey"], "status") == []
    assert stored_files(path) == before


def test_rows_of_a_repeated_key(spark):
    rows = spark.createDataFrame([(1, "a", "F"), (1, "b", "F"), (1, "b", "F"), (None, "a", "F"), (None, "c", "O"), (2, "c", None)], "k int, no string, status string")
    path = scratch_path(spark, "repeated")
    schema = write_partitioned(rows, path, "status")

    def rule(df):
        return update(df, F.col("no") == "a", {"no": "new"})

    changes = change_set(read_partitioned(spark, path, schema), "status", rule, repeated_keys=["k"])
    apply_changes(spark, path, schema, changes, ["k"], "status")
    assert held(read_partitioned(spark, path, schema)) == held(rule(rows))


# ---- maintained views


def test_view_equals_recomputation_after_each_load(spark, smoke_dir):
    li = load(spark, smoke_dir, "lineitem").select("l_suppkey", M.money("l_extendedprice").alias("total"), "l_shipdate", F.when(F.col("l_linenumber") > 2, 1).alias("late"))
    measures = {"sum_total": ("sum", "total"), "n_late": ("count", "late"), "first": ("min", "l_shipdate"), "last": ("max", "l_shipdate")}
    view = MaintainedView(spark, scratch_path(spark, "view"), li, ["l_suppkey"], measures)
    assert view.read().collect() == []
    parts = [li.where(F.col("l_suppkey") % 2 == 0), li.where((F.col("l_suppkey") % 2 == 1) & F.col("late").isNull()), li.where((F.col("l_suppkey") % 2 == 1) & F.col("late").isNotNull())]
    seen = None
    for k, part in enumerate(parts):
        assert view.load(part, f"b{k}") and not view.load(part, f"b{k}")
        seen = part if seen is None else seen.union(part)
        plain = seen.groupBy("l_suppkey").agg(
            F.sum("total").cast("decimal(38,4)").alias("sum_total"), F.count("late").alias("n_late"), F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"))
        assert held(view.read()) == held(plain)
        assert view.read().schema["sum_total"].dataType.simpleString() == "decimal(38,4)"
    view.fold("fold")
    assert held(view.read()) == held(plain) and view.table.read().count() == plain.count()
    with pytest.raises(ValueError):
        MaintainedView(spark, "x", li, ["l_suppkey"], {"m": ("avg", "total")})


# ---- ordered tables


def test_ordered_table_is_read_back_in_order(spark, smoke_dir):
    """A third of the rows share one value; it lies over several files."""
    rows = load(spark, smoke_dir, "orders").select(
        F.when(F.col("o_orderkey") % 3 == 0, "hot").when(F.col("o_orderkey") % 50 == 1, None).otherwise(F.col("o_orderpriority")).alias("p"), "o_orderkey", "o_custkey")
    path = scratch_path(spark, "ordered")
    schema = ordered.write_ordered(rows, path, ["p", "o_orderkey"], n_files=7, rows_per_file=100)
    want = [tuple(r) for r in rows.orderBy("p", "o_orderkey", "o_custkey").collect()]
    assert [tuple(r) for r in ordered.stream_ordered(spark, path, schema)] == want
    placed = ordered.read_positions(spark, path, schema)
    assert [tuple(r) for r in sorted(placed.collect(), key=lambda r: r.position)] == [(*w, i) for i, w in enumerate(want, 1)]
    b = ordered.bounds(spark, path).collect()
    assert len(b) >= 7 and sum(r.lo.p == "hot" == r.hi.p for r in b) >= 2
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "Sort " not in plan and "rangepartitioning" not in plan.lower()


def test_a_range_reads_only_its_files(spark, smoke_dir):
    rows = load(spark, smoke_dir, "orders").select("o_orderkey", "o_totalprice")
    path = scratch_path(spark, "ordered")
    schema = ordered.write_ordered(rows, path, ["o_orderkey"], n_files=8)
    lo, hi = rows.selectExpr("percentile_disc(0.4) within group (order by o_orderkey)", "percentile_disc(0.5) within group (order by o_orderkey)").first()
    part = ordered.between(spark, path, schema, lo, hi)
    assert held(part) == held(rows.where(F.col("o_orderkey").between(lo, hi)))
    assert 1 <= len(part.inputFiles()) <= 3
    assert ordered.between(spark, path, schema, 10**12, 10**13).collect() == []


def test_ordered_table_of_equal_rows_and_of_none(spark):
    same = spark.range(500).select(F.lit(1).alias("x"))
    path = scratch_path(spark, "ordered")
    schema = ordered.write_ordered(same, path, ["x"], n_files=4)
    assert sorted(r.position for r in ordered.read_positions(spark, path, schema).collect()) == list(range(1, 501))
    path = scratch_path(spark, "ordered")
    schema = ordered.write_ordered(same.limit(0), path, ["x"])
    assert list(ordered.stream_ordered(spark, path, schema)) == [] and ordered.read_positions(spark, path, schema).collect() == []


# ---- keys across loads


def test_repeats_across_loads_are_found_and_none_falsely(spark):
    layout = spark.createDataFrame([], "a long, b string").schema
    known = KnownKeys(spark, scratch_path(spark, "known"), layout, blocks_for(3000))
    make = lambda lo, hi: spark.range(lo, hi).select(F.col("id").alias("a"), F.concat(F.lit("k"), "id").alias("b"))
    assert known.repeated(make(0, 10)).collect() == []
    assert known.add(make(0, 1000), "one") and not known.add(make(0, 1000), "one")
    known.add(make(1000, 3000), "two")
    asked = make(2990, 6000).union(make(5, 8)).union(make(5, 8)).union(spark.createDataFrame([(None, "k1"), (1, None)], layout))
    assert sorted(r.a for r in known.repeated(asked).collect()) == [5, 6, 7, *range(2990, 3000)]


def test_a_filter_that_is_too_full_costs_no_result(spark):
    layout = spark.createDataFrame([], "a long").schema
    known = KnownKeys(spark, scratch_path(spark, "known"), layout, 1)
    known.add(spark.range(2000).toDF("a"), "one")
    assert sorted(r.a for r in known.repeated(spark.range(1990, 4000).toDF("a")).collect()) == list(range(1990, 2000))


def test_the_filter_leaves_few_false_hits(spark):
    layout = spark.createDataFrame([], "a long").schema
    known = KnownKeys(spark, scratch_path(spark, "known"), layout, blocks_for(20_000))
    known.add(spark.range(20_000).toDF("a"), "one")
    known.keys = type("All", (), {"read": lambda self: spark.range(100_000).toDF("a")})()  # every hit would be confirmed
    assert known.repeated(spark.range(50_000, 70_000).toDF("a")).count() < 20_000 * 0.03


def test_foreign_keys_by_blocks(spark, smoke_dir):
    child = spark.createDataFrame([(k,) for k in [1, 1, 2, 63, 64, 65, -1, -64, -65, None, 2**40, 2**40]], "k long")
    parent = spark.createDataFrame([(1,), (64,), (-64,), (None,), (128,)], "p long")
    assert held(fk_violations_by_blocks(child, "k", parent, "p")) == held(fk_violations(child, ["k"], parent, ["p"]))
    li, part = load(spark, smoke_dir, "lineitem"), load(spark, smoke_dir, "part").where(F.col("p_type").startswith("S"))
    got = fk_violations_by_blocks(li, "l_partkey", part, "p_partkey")
    assert held(got) == held(fk_violations(li, ["l_partkey"], part, ["p_partkey"])) and got.schema["l_partkey"] == li.schema["l_partkey"]
    n = collections.Counter(r.l_partkey >> 6 for r in li.select("l_partkey").distinct().collect())
    assert len(n) * 30 < sum(n.values())  # rows that are shuffled against keys
    assert fk_violations_by_blocks(child, "k", parent.limit(0), "p").count() == 9
