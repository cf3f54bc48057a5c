"""Check queries that run a load step as an incremental stream (UPD-7, UPD-6 on a file stream)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relprep.fixed import MASK_FIRST_DIGITS, STORE_FILL_RULES
from relprep.operators.updates import fill_from_key, mask_by_prefix
from relprep.plans.registry import CHECKS, check
from relprep.plans.rules import SALT_MASK
from relprep.sources.tables import load
from relprep.streaming import run_to_table, table_stream


@check("q_mask_by_prefix_stream", CHECKS["q_mask_by_prefix"].sql, ("UPD-7", "FLT-5", "SRC-1"))
def q_mask_by_prefix_stream(spark: SparkSession, base: str) -> DataFrame:
    """The masking rule applied to the orders file stream, read back from the sink."""

    def steps(df: DataFrame) -> DataFrame:
        o = df.select("o_orderkey", F.col("o_orderpriority").alias("order_no"))
        return mask_by_prefix(o, "order_no", MASK_FIRST_DIGITS, "o_orderkey", SALT_MASK)

    return run_to_table(table_stream(spark, base, "orders"), steps)


@check("q_fill_from_key_stream", CHECKS["q_fill_from_key"].sql, ("UPD-6", "STR-3", "JOIN-1"))
def q_fill_from_key_stream(spark: SparkSession, base: str) -> DataFrame:
    """Stream-static join (orders stream x customer table) then the fill rule."""
    customer = load(spark, base, "customer")

    def steps(df: DataFrame) -> DataFrame:
        j = df.join(customer, df.o_custkey == customer.c_custkey)
        o = j.select("o_orderkey", F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey").cast("long")).alias("store_id"))
        return fill_from_key(o, "store_id", "o_orderkey", STORE_FILL_RULES)

    return run_to_table(table_stream(spark, base, "orders"), steps)
