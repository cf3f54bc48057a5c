"""Data-quality checks that replace enforced constraints (DQ-1..7).

Parquet tables cannot enforce PRIMARY KEY, UNIQUE, FOREIGN KEY or CHECK.
Each check returns a DataFrame of violations computed on the cluster:

* key checks are one grouped aggregate (partial aggregation before the
  shuffle, so a key holding a third of the rows is pre-combined per task);
* the foreign-key check first reduces the child to one row per key, then
  anti-joins those keys against the parent keys, so a hot child key is
  one row by the time it reaches the join;
* column profiles are a single pass with one output row per column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relprep.functions.text import tsql_len


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def pk_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Primary key (single or composite): duplicated or NULL keys (DQ-1, DQ-2).

    One row per offending key with ``n_rows`` and ``reason``.
    """
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    bad = _any_null(keys)
    return grouped.filter((F.col("n_rows") > 1) | bad).withColumn(
        "reason", F.when(bad, F.lit("null_key")).otherwise(F.lit("duplicate"))
    )


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """UNIQUE on a non-key column (DQ-4): values held by more than one row.

    As in SQL Server, NULL counts as a value, so two NULLs violate.
    """
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def fk_violations(child: DataFrame, child_keys: list[str], parent: DataFrame, parent_keys: list[str]) -> DataFrame:
    """FOREIGN KEY (DQ-3): non-NULL child keys without a parent row, with
    the number of child rows holding each."""
    not_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in child_keys])
    per_key = child.filter(not_null).groupBy(*child_keys).agg(F.count(F.lit(1)).alias("n_rows"))
    parents = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_keys, child_keys)])
    return per_key.join(parents, child_keys, "left_anti")


def fk_violations_by_blocks(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """FOREIGN KEY (DQ-3) of a whole-number key, for tables far larger than a shuffle should be.

    The same rows as ``fk_violations``.  Both sides are reduced in their own
    tasks to one row for 64 neighbouring keys, with a bit for each key that
    occurs, so with the usual dense keys a sixty-fourth of the keys is
    shuffled.  The blocks that hold a bit without a parent give the orphans;
    the child is scanned again to count only their rows.
    """
    def blocks(df: DataFrame, key: str, mask: str) -> DataFrame:
        k = F.col(key).cast("long")
        bit = F.expr(f"shiftleft(1L, cast(cast(`{key}` as long) & 63 as int))")
        return df.where(k.isNotNull()).groupBy(F.shiftright(k, 6).alias("__block")).agg(F.bit_or(bit).alias(mask))

    met = blocks(child, child_key, "__child").join(blocks(parent, parent_key, "__parent"), "__block", "left")
    lone = F.col("__child").bitwiseAND(F.bitwise_not(F.coalesce("__parent", F.lit(0).cast("long"))))
    bits = met.select("__block", lone.alias("__lone")).where("__lone <> 0").withColumn("__bit", F.explode(F.sequence(F.lit(0), F.lit(63))))
    bits = bits.where("(shiftright(__lone, __bit) & 1) = 1")
    orphans = bits.select((F.shiftleft("__block", 6) + F.col("__bit")).cast(child.schema[child_key].dataType).alias(child_key))
    return child.select(child_key).join(orphans, child_key, "left_semi").groupBy(child_key).agg(F.count(F.lit(1)).alias("n_rows"))


def profile(df: DataFrame, max_lengths: dict[str, int], not_null: list[str] | None = None) -> DataFrame:
    """NOT NULL and NVARCHAR(n) checks in one pass (DQ-5, DQ-6).

    One row per column: ``column, max_len, n_null, n_too_long`` where
    lengths follow LEN (trailing spaces ignored).  Columns listed in
    ``not_null`` but not in ``max_lengths`` get ``max_len``/``n_too_long``
    NULL.
    """
    cols = list(dict.fromkeys(list(max_lengths) + list(not_null or [])))
    aggs = []
    for c in cols:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"{c}__null"))
        if c in max_lengths:
            aggs.append(F.max(tsql_len(c)).cast("long").alias(f"{c}__max"))
            aggs.append(F.count_if(tsql_len(c) > max_lengths[c]).alias(f"{c}__long"))
    wide = df.agg(*aggs)
    rows = []
    for c in cols:
        rows.append(F.struct(
            F.lit(c).alias("column"),
            (F.col(f"{c}__max") if c in max_lengths else F.lit(None).cast("long")).alias("max_len"),
            F.col(f"{c}__null").alias("n_null"),
            (F.col(f"{c}__long") if c in max_lengths else F.lit(None).cast("long")).alias("n_too_long"),
        ))
    return wide.select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def length_violations(df: DataFrame, max_lengths: dict[str, int]) -> DataFrame:
    """Rows with a value longer than its NVARCHAR(n) limit (DQ-6)."""
    pred = reduce(lambda a, b: a | b, [tsql_len(c) > n for c, n in max_lengths.items()])
    return df.filter(pred)


def check_violations(df: DataFrame, pred: Column) -> DataFrame:
    """CHECK (pred) (DQ-7): rows where pred is false.  NULL passes, as in SQL."""
    return df.filter(~F.coalesce(pred, F.lit(True)))
