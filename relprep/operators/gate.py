"""Constraints that act on a load: accepted rows, rejected rows and why (DQ-1..7).

``INSERT`` into a table with constraints refuses rows that break them.  A gate
does so for a whole load at once: one written pass sets the rows apart with
the names of all the constraints that each one breaks, and the counts are
taken while it is written (``observe``), not by further scans.

* NOT NULL, length and CHECK rules are expressions of the row.
* Keys: all rows of a repeated key are set apart, as are rows with a null in
  a primary key; which of them is right is not the gate's to say.  Repeated
  keys are found by a pre-aggregated count, and only those meet the rows.
* Foreign keys: a row whose key is not null and has no parent.  Child keys are
  reduced to the orphans first (one row a key), and only those meet the rows.

So what rows are joined with are the few keys in error, on the side that
Spark may broadcast; a key that a third of the rows share is one row there.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from relprep.functions.text import tsql_len
from relprep.operators.quality import fk_violations
from relprep.session import scratch_path


@dataclass(frozen=True)
class Constraints:
    """What a table demands of its rows.

    ``primary``, ``unique``: names of columns; ``foreign``: (columns, parent
    table, its columns); ``checks``: name -> predicate that must not be false.
    """

    not_null: Sequence[str] = ()
    max_length: Mapping[str, int] = field(default_factory=dict)
    checks: Mapping[str, Column] = field(default_factory=dict)
    primary: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    foreign: Sequence[tuple[Sequence[str], DataFrame, Sequence[str]]] = ()


@dataclass(frozen=True)
class Gated:
    """``rejected`` has the rows' columns and ``reasons``; ``counts`` the rows by verdict and by reason."""

    accepted: DataFrame
    rejected: DataFrame
    counts: Mapping[str, int]


def _all(preds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds)


def _met(df: DataFrame, bad: DataFrame, keys: Sequence[str], mark: str) -> DataFrame:
    """``df`` with the column ``mark``: whether its key is one of ``bad``; null equals null."""
    names = [f"{mark}_{i}" for i in range(len(keys))]
    bad = bad.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.lit(True).alias(mark))
    return df.join(bad, _all([F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]), "left").drop(*names)


def row_rules(c: Constraints) -> dict[str, Column]:
    """The rules that need nothing but the row: name -> whether it is broken."""
    rules = {f"not_null:{x}": F.col(x).isNull() for x in c.not_null}
    rules |= {f"length:{x}": F.coalesce(tsql_len(x) > n, F.lit(False)) for x, n in c.max_length.items()}
    rules |= {f"check:{name}": ~F.coalesce(p, F.lit(True)) for name, p in c.checks.items()}
    if c.primary:
        rules["null_key"] = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in c.primary])
    return rules


def judged(df: DataFrame, c: Constraints) -> DataFrame:
    """``df`` with ``reasons``, the sorted names of the constraints that a row breaks."""
    if "reasons" in df.columns:
        raise ValueError("the rows have a column named reasons")
    rules, out, marks = row_rules(c), df, []

    def meet(bad: DataFrame, keys: Sequence[str], name: str) -> None:
        nonlocal out
        marks.append(f"__broken_{len(marks)}")
        out = _met(out, bad, keys, marks[-1])
        rules[name] = F.coalesce(F.col(marks[-1]), F.lit(False))

    keys = ([("primary", list(c.primary))] if c.primary else []) + [("unique", list(u)) for u in c.unique]
    for kind, cols in keys:
        counted = df if kind == "unique" else df.where(_all([F.col(k).isNotNull() for k in cols]))
        meet(counted.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), cols, f"{kind}:{','.join(cols)}")
    for cols, parent, parent_cols in c.foreign:
        meet(fk_violations(df, list(cols), parent, list(parent_cols)), list(cols), f"foreign:{','.join(cols)}")
    named = [F.when(broken, F.lit(name)) for name, broken in rules.items()]
    reasons = F.sort_array(F.array_compact(F.array(*named))) if named else F.array().cast("array<string>")
    return out.withColumn("reasons", reasons).drop(*marks)


def rule_names(c: Constraints) -> list[str]:
    keyed = ([f"primary:{','.join(c.primary)}"] if c.primary else []) + [f"unique:{','.join(u)}" for u in c.unique]
    return [*row_rules(c), *keyed, *[f"foreign:{','.join(cols)}" for cols, _, _ in c.foreign]]


def gate(df: DataFrame, c: Constraints, path: str | None = None) -> Gated:
    """Write the judged rows once, by verdict, and return both parts and the counts.

    Each part reads its own folder only.  ``path`` defaults to a scratch table.
    """
    path = path or scratch_path(df.sparkSession, "gated")
    names, counted = rule_names(c), Observation()
    rows = judged(df, c).withColumn("__accepted", F.size("reasons") == 0)
    counts = [F.count(F.lit(1)).alias("rows"), F.count_if("__accepted").alias("accepted")]
    counts += [F.count_if(F.array_contains("reasons", n)).alias(f"r{i}") for i, n in enumerate(names)]
    rows.observe(counted, *counts).write.mode("errorifexists").partitionBy("__accepted").parquet(path)
    found = counted.get
    back = df.sparkSession.read.schema(rows.schema).parquet(path)
    return Gated(
        back.where("__accepted").select(*df.columns),
        back.where("NOT __accepted").select(*df.columns, "reasons"),
        {"rows": found["rows"], "accepted": found["accepted"], "rejected": found["rows"] - found["accepted"]} | {n: found[f"r{i}"] for i, n in enumerate(names)},
    )
