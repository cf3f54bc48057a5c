"""Dense ordered surrogate keys: IDENTITY(seed, step) (PRJ-6).

``row_number() OVER (ORDER BY k)`` without a partition moves every row into
one task.  This operator numbers rows in parallel instead:

1. ``repartitionByRange`` on the ordering key: partition i holds a
   contiguous key range, all keys below partition i+1's.
2. ``sortWithinPartitions`` and ``monotonically_increasing_id`` give each
   row its position inside its partition (the id is
   ``partition_index << 33 | position``).
3. One small aggregate counts rows per partition (one row per partition,
   so its size is bounded by the partition count, not by the data), a
   running sum over those few rows gives each partition's offset, and a
   broadcast join adds the offset back.

Ordering is made total by appending every remaining column as a
tie-breaker, so equal keys spread over several range partitions.  Rows that
are equal in every column are told apart by their place in the input, so
they spread as well; which of them gets which number makes no difference.

The numbered rows are written once as Parquet to the shared folder in
``spark.checkpoint.dir`` before the counts are taken.  Both the counts and
the final join then read the same files: the partition bounds are sampled
once, whatever the optimizer decides about reusing exchanges, and the rows
are sorted once.  Select the columns you need first: only those are written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relprep.session import scratch_path
from relprep.sources.sinks import materialize

_POS_BITS = 33


def with_identity(
    df: DataFrame,
    order_by: list[str],
    alias: str,
    seed: int = 1,
    step: int = 1,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``alias = seed + step * (rank - 1)`` with rank dense over ``order_by`` (PRJ-6)."""
    ties = [c for c in df.columns if c not in order_by]
    order: list[Column] = [F.col(c).asc_nulls_first() for c in order_by + ties]
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order.append(F.col("_input"))
    ranged = (
        df.withColumn("_input", F.monotonically_increasing_id())
        .repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .drop("_input")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(F.col("_part").cast("long"), _POS_BITS))
    )
    ranged = materialize(ranged, scratch_path(df.sparkSession, "identity"))
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a single-task window over at most n rows.
    offsets = counts.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).alias("_offset"),
    ).fillna(0, subset=["_offset"])
    out = ranged.join(F.broadcast(offsets), "_part")
    rank0 = F.col("_offset") + F.col("_pos")
    return out.withColumn(alias, F.lit(seed) + F.lit(step) * rank0).drop("_part", "_pos", "_offset")
