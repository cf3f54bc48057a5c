"""The load gate and the join that spreads heavy keys."""

import collections

import pytest
from pyspark.sql import functions as F

from relprep.operators.gate import Constraints, gate, judged
from relprep.operators.heavy import heavy_join, heavy_keys
from relprep.sources.tables import load

ROWS = [
    (1, 1, "ok", 5, 10),
    (2, 1, "twice", 5, 10),
    (2, 1, "twice", 6, 10),
    (3, None, "null key", 5, 10),
    (4, None, "null key", 5, None),
    (5, 1, "much too long", 5, 10),
    (6, 1, "negative", -1, 99),
    (7, 1, None, None, 98),
    (8, 1, "ok   ", 7, 10),
]


def constraints(spark):
    parents = spark.createDataFrame([(10,), (11,), (None,)], "p int")
    return Constraints(
        not_null=["name"], max_length={"name": 8}, checks={"positive": F.col("qty") > 0}, primary=["a", "b"], unique=[["name"]], foreign=[(["ref"], parents, ["p"])]
    )


def test_reasons_of_each_row(spark):
    df = spark.createDataFrame(ROWS, "a int, b int, name string, qty int, ref int")
    got = collections.Counter((r.a, tuple(r.reasons)) for r in judged(df, constraints(spark)).collect())
    assert got == collections.Counter([
        (1, ()), (2, ("primary:a,b", "unique:name")), (2, ("primary:a,b", "unique:name")),
        (3, ("null_key", "unique:name")), (4, ("null_key", "unique:name")), (5, ("length:name",)),
        (6, ("check:positive", "foreign:ref")), (7, ("foreign:ref", "not_null:name")), (8, ()),
    ])


def test_gate_sets_rows_apart_once_and_counts_them(spark):
    df = spark.createDataFrame(ROWS, "a int, b int, name string, qty int, ref int")
    g = gate(df, constraints(spark))
    assert sorted(r.a for r in g.accepted.collect()) == [1, 8] and g.accepted.columns == df.columns
    assert g.rejected.count() == 7 and g.rejected.columns == [*df.columns, "reasons"]
    assert g.counts == {
        "rows": 9, "accepted": 2, "rejected": 7, "not_null:name": 1, "length:name": 1, "check:positive": 1, "null_key": 2,
        "primary:a,b": 2, "unique:name": 4, "foreign:ref": 2,
    }
    plan = g.accepted._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "__accepted" in plan


def test_gate_of_nothing(spark):
    df = spark.createDataFrame([], "a int, b int, name string, qty int, ref int")
    g = gate(df, constraints(spark))
    assert g.accepted.collect() == [] and g.rejected.collect() == [] and g.counts["rows"] == 0
    whole = gate(spark.createDataFrame(ROWS, "a int, b int, name string, qty int, ref int"), Constraints())
    assert whole.accepted.count() == 9 and whole.counts["rejected"] == 0
    with pytest.raises(ValueError):
        judged(df.withColumn("reasons", F.lit(1)), Constraints())


def test_a_hot_foreign_key_and_a_hot_repeated_key(spark):
    hot = spark.range(30_000).select((F.col("id") % 3).alias("k"), F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("ref"))
    g = gate(hot, Constraints(unique=[["k"]], foreign=[(["ref"], spark.createDataFrame([(9,)], "p long"), ["p"])]))
    assert g.counts["rows"] == 30_000 and g.counts["unique:k"] == 30_000 and g.counts["foreign:ref"] == 29_999


# ---- heavy keys


def sides(spark):
    """Key 1 heavy left, 2 heavy right, 3 heavy on both sides, null heavy left, 9 absent right."""
    left = [1] * 3000 + [2] * 4 + [3] * 400 + [None] * 2000 + [9] * 2000 + list(range(10, 60))
    right = [1] * 3 + [2] * 3000 + [3] * 500 + [None] * 100 + list(range(30, 90))
    a = spark.createDataFrame([(k, i // 2) for i, k in enumerate(left)], "k int, x int").repartition(4, "x")
    b = spark.createDataFrame([(k, i // 2) for i, k in enumerate(right)], "k int, y int").repartition(4, "y")
    return a, b


@pytest.mark.parametrize("how", ["inner", "left"])
def test_heavy_join_equals_the_join(spark, how):
    a, b = sides(spark)
    got = collections.Counter(tuple(r) for r in heavy_join(a, b, ["k"], how, share=0.05, rows_per_part=100).collect())
    assert got == collections.Counter(tuple(r) for r in a.join(b, "k", how).collect())


def test_heavy_sides_are_spread_over_tasks(spark):
    a, b = sides(spark)
    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def tasks(df, key):
            return df.where(F.col("k") == key).select(F.spark_partition_id().alias("t")).distinct().count()

        spread = heavy_join(a, b, ["k"], "left", share=0.05, rows_per_part=100)
        assert tasks(a.join(b, "k", "left"), 2) == 1
        assert tasks(spread, 1) > 4 and tasks(spread, 2) > 4 and tasks(spread, 3) > 2
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_heavy_keys_are_bounded_and_ignore_null(spark):
    a, _ = sides(spark)
    assert {r.k: r.n for r in heavy_keys(a, ["k"], 0.05).collect()} == {1: 3000, 3: 400, 9: 2000}
    with pytest.raises(ValueError):
        heavy_join(a, a, ["k"])
    with pytest.raises(ValueError):
        heavy_join(a, a.withColumnRenamed("x", "y"), ["k"], "full")


def test_heavy_join_on_driver_tables(spark, smoke_dir):
    o = load(spark, smoke_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey")).alias("k"))
    c = load(spark, smoke_dir, "customer").select(F.col("c_custkey").alias("k"), "c_name")
    got = heavy_join(c, o, ["k"], "left", share=0.05, rows_per_part=50)
    assert sorted(map(str, got.collect())) == sorted(map(str, c.join(o, "k", "left").collect()))
