"""Maintained views: stored partial aggregates that each load is folded into (PRM-4, AGG-1, AGG-4, AGG-6).

A view such as ``SELECT client, SUM(total), COUNT(no), MIN(d), MAX(d) ...
GROUP BY client`` read again after each load scans the whole table again.
Sums, counts, minima and maxima of parts merge, so a maintained view
aggregates only the rows of a new batch, appends that small result to a
``BatchTable`` (once, also if the load is rerun), and merges the stored parts
when it is read.  ``fold`` merges them for good when there are many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from relprep.sources.batches import BatchTable

#: measure -> (its aggregate over rows, the aggregate that merges parts of it)
MERGES = {"sum": (F.sum, F.sum), "count": (F.count, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}


class MaintainedView:
    """``SELECT keys, measures GROUP BY keys`` over all batches loaded so far.

    ``measures``: name -> (one of sum, count, min, max, column).  ``source`` is
    any DataFrame with the columns of the batches; only its schema is used.
    ``avg`` is a sum over a count, which the reader divides as it needs.
    """

    def __init__(self, spark: SparkSession, path: str, source: DataFrame, keys: list[str], measures: dict[str, tuple[str, str]]):
        unknown = {kind for kind, _ in measures.values()} - set(MERGES)
        if unknown:
            raise ValueError(f"parts of {sorted(unknown)} do not merge")
        self.keys, self.measures = keys, measures
        self.table = BatchTable(spark, path, self._partial(source).schema)

    def _wide(self, value: Column, df: DataFrame, kind: str, column: str) -> Column:
        """Sums of decimals keep one type, however often they are merged."""
        t = df.schema[column].dataType
        return value.cast(DecimalType(38, t.scale)) if kind == "sum" and isinstance(t, DecimalType) else value

    def _partial(self, df: DataFrame) -> DataFrame:
        aggs = [self._wide(MERGES[kind][0](c), df, kind, c).alias(name) for name, (kind, c) in self.measures.items()]
        return df.groupBy(*self.keys).agg(*aggs)

    def _merged(self, parts: DataFrame) -> DataFrame:
        aggs = [self._wide(MERGES[kind][1](name), parts, kind, name).alias(name) for name, (kind, _) in self.measures.items()]
        return parts.groupBy(*self.keys).agg(*aggs)

    def load(self, df: DataFrame, batch: str) -> bool:
        """Fold the rows of ``df`` in as batch ``batch``, unless that was done before."""
        return self.table.load(self._partial(df), batch)

    def read(self) -> DataFrame:
        return self._merged(self.table.read())

    def fold(self, batch: str) -> bool:
        """Merge the stored parts into one."""
        return self.table.fold(batch, self._merged)
