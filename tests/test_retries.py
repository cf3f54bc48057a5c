"""Task failures and retries must not change results.

A Python UDF in this test (only here) fails the first attempt of one task;
Spark retries it. Keyed tokens, identity keys and staged writes are pure
functions of the data, so the retried run equals a failure-free run.
"""

from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from relprep.functions.text import keyed_token
from relprep.operators.keys import with_identity


def _flaky():
    # Defined inside a function so the UDF is shipped by value to workers.
    def fail_first_attempt_of_partition_0(x):
        ctx = TaskContext.get()
        if ctx is not None and ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
            raise RuntimeError("injected task failure")
        return True

    return F.udf(fail_first_attempt_of_partition_0, BooleanType())


def test_tokens_identical_after_task_retry(spark):
    df = spark.range(0, 5000, numPartitions=4).withColumn("tok", keyed_token("id", salt="s", length=25))
    clean = sorted(map(tuple, df.collect()))
    retried = sorted(map(tuple, df.filter(_flaky()(F.col("id"))).collect()))
    assert retried == clean


def test_identity_identical_after_task_retry(spark):
    base = spark.range(0, 3000, numPartitions=5).select((F.col("id") % 97).alias("k"), F.col("id").alias("v"))
    clean = sorted(map(tuple, with_identity(base, ["k"], "ident", num_partitions=6).collect()))
    retried_input = base.filter(_flaky()(F.col("v")))
    retried = sorted(map(tuple, with_identity(retried_input, ["k"], "ident", num_partitions=6).collect()))
    assert retried == clean
