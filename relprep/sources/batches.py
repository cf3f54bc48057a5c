"""Tables that are loaded batch by batch: append once, keys that go on (SNK-1, PRJ-6, PRJ-7).

``INSERT INTO target (columns) SELECT ...`` run again appends its rows again,
and an identity column goes on from the last number given.  A table of this
module is a folder of batches and a folder of commits:

* a batch's rows are written to a folder of their own, then one commit record
  names it with its number of rows and the identity's next value.  Readers
  take the committed batches only, so a load that dies leaves nothing behind
  that anyone reads, and the next try overwrites it;
* a batch that is committed is not loaded again, so a whole load can be rerun;
* the identity of a batch starts at the next value of the last commit:
  numbers are dense over all loads and never given twice, also when a task or
  the whole load is retried.

One loader at a time: of two that start from the same state the later commit
fails.  Nothing but the commit records (one a load) reaches the driver; the
rows are counted while they are written.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from relprep.operators.keys import with_identity
from relprep.sources import files
from relprep.sources.sinks import with_defaults


@dataclass(frozen=True)
class Identity:
    """``column IDENTITY(seed, step)``; rows of one load are numbered by ``order_by``."""

    column: str
    order_by: tuple[str, ...]
    seed: int = 1
    step: int = 1


class BatchTable:
    """A target table in ``path`` with columns ``layout``, their defaults and an identity column."""

    def __init__(self, spark: SparkSession, path: str, layout: StructType, defaults: dict[str, Any] | None = None, identity: Identity | None = None):
        self.spark, self.path, self.layout = spark, path.rstrip("/"), layout
        self.defaults, self.identity = defaults or {}, identity
        if identity and identity.column not in layout.names:
            raise ValueError(f"{identity.column} is not a column of the table")

    def commits(self) -> list[dict[str, Any]]:
        return list(files.records(self.spark, f"{self.path}/commits").values())

    def load(self, df: DataFrame, batch: str) -> bool:
        """Append the rows of ``df`` as batch ``batch`` unless that is committed; says whether it did.

        Columns are matched by name, omitted ones take their default.
        """
        return self._commit(df, batch, replaces=[])

    def _commit(self, df: DataFrame, batch: str, replaces: list[str]) -> bool:
        commits = self.commits()
        if any(c["batch"] == batch for c in commits):
            return False
        number, following = len(commits), None
        if self.identity and not replaces:
            following = self.next_value()
            shaped = with_defaults(df, self._without_identity(), self.defaults)
            shaped = with_identity(shaped, list(self.identity.order_by), self.identity.column, following, self.identity.step)
            shaped = with_defaults(shaped, self.layout)
        else:
            shaped = with_defaults(df, self.layout, self.defaults)
        folder = f"{number:08d}-{hashlib.md5(batch.encode()).hexdigest()[:8]}"
        counted = Observation()
        shaped.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{self.path}/data/{folder}")
        rows = counted.get["rows"]
        record = {"batch": batch, "folder": folder, "rows": rows, "replaces": replaces}
        if self.identity:
            record["next"] = self.next_value() if replaces else following + self.identity.step * rows
        files.put_record(self.spark, f"{self.path}/commits/{number:08d}.json", record)
        return True

    def _without_identity(self) -> StructType:
        return StructType([f for f in self.layout.fields if f.name != self.identity.column])

    def next_value(self) -> int:
        """The identity value that the next row gets."""
        commits = self.commits()
        return commits[-1]["next"] if commits else self.identity.seed

    def folders(self) -> list[str]:
        """The committed folders that no later commit replaces."""
        commits = self.commits()
        gone = {f for c in commits for f in c["replaces"]}
        return [c["folder"] for c in commits if c["folder"] not in gone]

    def read(self) -> DataFrame:
        """The rows of all committed batches."""
        folders = self.folders()
        if not folders:
            return self.spark.createDataFrame([], self.layout)
        return self.spark.read.schema(self.layout).parquet(*[f"{self.path}/data/{f}" for f in folders])

    def fold(self, batch: str, how) -> bool:
        """Replace all batches by ``how(rows)`` as one, in one commit; their folders go afterwards.

        A fold that died after its commit is finished by the next one.
        """
        done = self._commit(how(self.read()), batch, replaces=self.folders())
        for c in self.commits():
            for f in c["replaces"]:
                files.remove(self.spark, f"{self.path}/data/{f}")
        return done
