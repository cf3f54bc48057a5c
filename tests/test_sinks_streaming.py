"""Write paths (SNK-1..4) and the incremental stream load."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from relprep.session import checkpoint_dir, scratch_path
from relprep.sources import sinks
from relprep.sources.tables import typed
from relprep.streaming import run_to_table, table_stream

LAYOUT = StructType([
    StructField("id", LongType(), False),
    StructField("name", StringType(), True),
    StructField("notes", StringType(), True),
    StructField("created", DateType(), True),
])


def test_with_defaults_only_for_omitted_columns(spark):
    # PRJ-7: an explicit NULL stays NULL; an omitted column takes its default
    df = spark.createDataFrame([(1, None)], "id long, name string")
    out = sinks.with_defaults(df, LAYOUT, {"name": "dflt", "notes": "Lorem ipsum"}).first()
    assert out.name is None and out.notes == "Lorem ipsum" and out.created is None
    shaped = sinks.with_defaults(df, LAYOUT)
    assert shaped.schema.fieldNames() == ["id", "name", "notes", "created"]
    assert [f.dataType for f in shaped.schema] == [f.dataType for f in LAYOUT]


def test_append_by_name_and_position(spark):
    path = scratch_path(spark, "t-append")
    sinks.append(spark.createDataFrame([(1, "a")], "id long, name string"), path, LAYOUT, {"notes": "n"})
    sinks.append_positional(spark.createDataFrame([(2, "b", "x", None)], "a long, b string, c string, d date"), path, LAYOUT)
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("id", "name", "notes").collect())
    assert got == [(1, "a", "n"), (2, "b", "x")]
    with pytest.raises(ValueError):
        sinks.append_positional(spark.createDataFrame([(3,)], "a long"), path, LAYOUT)


def test_materialize_refuses_existing_table(spark):
    path = scratch_path(spark, "t-ctas")
    df = spark.range(10)
    assert sinks.materialize(df, path).count() == 10
    with pytest.raises(Exception):
        sinks.materialize(df, path)


def test_stage_random_columns_are_stable(spark):
    df = spark.range(100).withColumn("r", F.rand())
    staged = sinks.stage(df, "anes", deterministic=False)
    a = sorted(tuple(r) for r in staged.collect())
    b = sorted(tuple(r) for r in spark.table("anes").collect())
    assert a == b


def test_typed_casts_and_orders(spark):
    df = spark.createDataFrame([("7", "x", "2020-01-02")], "a string, b string, c string")
    out = typed(df, LAYOUT, {"id": "a", "name": "b", "created": F.col("c")})
    assert out.schema.fieldNames() == ["id", "name", "notes", "created"]
    r = out.first()
    assert r.id == 7 and r.notes is None and str(r.created) == "2020-01-02"


def test_checkpoint_dir_is_set_locally(spark):
    assert checkpoint_dir(spark)


def test_stream_load_matches_batch(spark, smoke_dir):
    from relprep.operators.updates import mask_by_prefix

    def steps(df):
        o = df.select("o_orderkey", F.col("o_orderpriority").alias("order_no"))
        return mask_by_prefix(o, "order_no", ["1", "3"], "o_orderkey", "s")

    streamed = run_to_table(table_stream(spark, smoke_dir, "orders"), steps, timeout_s=120)
    batch = steps(spark.read.parquet(f"{smoke_dir}/orders.parquet"))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_load_sees_a_rewritten_schema(spark, tmp_path):
    from relprep.sources.tables import load

    spark.range(3).write.parquet(str(tmp_path / "part.parquet"))
    assert load(spark, str(tmp_path), "part").columns == ["id"]
    spark.range(3).withColumn("more", F.lit(1)).write.mode("overwrite").parquet(str(tmp_path / "part.parquet"))
    assert load(spark, str(tmp_path), "part").columns == ["id", "more"]


def test_stream_reads_one_table_only(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "part.parquet"))
    spark.range(100, 105).write.parquet(str(tmp_path / "partial.parquet"))
    spark.range(200, 205).write.parquet(str(tmp_path / "part.parquets"))
    got = run_to_table(table_stream(spark, str(tmp_path), "part"), lambda df: df, timeout_s=120)
    assert sorted(r.id for r in got.collect()) == [0, 1, 2]
