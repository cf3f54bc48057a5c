"""Incremental loads with Structured Streaming.

The reference works in batch only (no streams, windows or state).  What
carries over to streams is its load step: ``INSERT INTO target SELECT ...``
followed by row-level rules (typed projection, masks, fills, tokens).  Those
steps are stateless, so the same DataFrame -> DataFrame functions run
unchanged on a streaming DataFrame, and new source files are loaded as
they arrive instead of re-reading the whole source.

Exactly-once: the file sink and its checkpoint (under the shared
``spark.checkpoint.dir``) record which files were committed; a restarted
query replays only uncommitted batches.  The keyed tokens (``text.keyed_*``)
are pure functions of the row key, so a replayed batch produces the same
values it did the first time, which a random NEWID() column would not.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from relprep.session import scratch_path
from relprep.sources.tables import load


def table_stream(spark: SparkSession, base: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream over exactly one driver table (``<base>/<name>.parquet``).

    The schema is taken from the current files (metadata only) and fixed
    for the stream, as file streams require.  A stream reads a folder or a
    pattern; the one-letter class makes a pattern that only this name fits,
    whether the table is one file or a folder of files.
    """
    base = str(base)
    schema = load(spark, base, name).schema
    reader = spark.readStream.schema(schema).option("basePath", base)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{base.rstrip('/')}/{name}.parque[t]")


def load_incrementally(
    stream: DataFrame,
    steps: Callable[[DataFrame], DataFrame],
    sink_path: str,
    checkpoint_path: str | None = None,
    partition_by: list[str] | None = None,
) -> StreamingQuery:
    """Apply the row-level ``steps`` to ``stream`` and append to a Parquet
    table, processing everything available now (then stopping)."""
    shaped = steps(stream)
    if shaped.isStreaming is False:
        raise ValueError("steps must keep the DataFrame streaming")
    writer = (
        shaped.writeStream.format("parquet")
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint_path or scratch_path(stream.sparkSession, "stream-ckpt"))
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start()


def run_to_table(
    stream: DataFrame,
    steps: Callable[[DataFrame], DataFrame],
    sink_path: str | None = None,
    timeout_s: float | None = None,
) -> DataFrame:
    """Run ``load_incrementally`` to completion and return the sink as a batch table."""
    spark = stream.sparkSession
    sink = sink_path or scratch_path(spark, "stream-sink")
    schema = steps(stream).schema  # planning only; the query below runs the steps
    q = load_incrementally(stream, steps, sink)
    finished = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if finished is False:
        q.stop()
        raise TimeoutError("incremental load did not finish in time")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(schema).parquet(sink)
