"""Flows of ordered steps that can be stopped and resumed (PRM-5).

A script of procedures runs them in a fixed order, each on the tables that
the one before left.  A ``Flow`` writes each step's table below the shared
checkpoint folder and records the step in a journal when its table is whole.
A flow of the same run id that starts again reads the tables of finished
steps and goes on with the first unfinished one, whose half-written table it
overwrites.  Scratch tables that a step makes on its way are removed with the
step; ``finish`` writes the targets, then removes everything else.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from relprep.session import checkpoint_dir, scratch_in
from relprep.sources import files


class Flow:
    """The steps of one run of the flow ``name``; ``run_id`` tells runs apart."""

    def __init__(self, spark: SparkSession, name: str, run_id: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/flows/{name}/{run_id}"
        self._at = 0
        self.ran: list[str] = []  # the steps that this start did run

    def _journal(self) -> str:
        return f"{self.root}/journal"

    def finished(self) -> list[str]:
        """Names of the finished steps, in their order."""
        return [r["step"] for r in files.records(self.spark, self._journal()).values()]

    def step(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The table that ``make`` returns, written; from the journal if the step is finished.

        Steps come in the same order on each start; another order is refused.
        """
        number, table = f"{self._at:04d}", f"{self.root}/steps/{self._at:04d}-{name}"
        self._at += 1
        done = files.records(self.spark, self._journal()).get(f"{number}.json")
        if done and done["step"] != name:
            raise ValueError(f"step {number} of this run is {done['step']}, not {name}; a changed flow needs a new run id")
        if not done:
            scratch = f"{self.root}/scratch/{number}"
            with scratch_in(scratch):
                df = make()
                df.write.mode("overwrite").parquet(table)
            done = {"step": name, "schema": df.schema.json()}
            files.put_record(self.spark, f"{self._journal()}/{number}.json", done)
            files.remove(self.spark, scratch)
            self.ran.append(name)
        return self.spark.read.schema(StructType.fromJson(json.loads(done["schema"]))).parquet(table)

    def finish(self, targets: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Write each target to its path, remove the flow's own tables and return the targets.

        Dying here loses nothing: the next start reads the steps' tables and writes the targets again.
        """
        out = {}
        for path, df in targets.items():
            df.write.mode("overwrite").parquet(path)
            out[path] = self.spark.read.schema(df.schema).parquet(path)
        files.remove(self.spark, self.root)
        return out

