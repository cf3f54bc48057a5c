"""Optional-parameter search procedures (FLT-10..12, PRM-1..3).

A procedure with NULL-default parameters becomes a Python function with
keyword arguments.  The supplied arguments are folded into one predicate
on the driver, so parameters that were not given never enter the plan and
the filter is pushed into the scan like any other.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relprep.functions.predicates import any_equal
from relprep.operators.aggregates import avg_of


def any_match(df: DataFrame, params: dict[str, Any], guard: Column | None = None) -> DataFrame:
    """WHERE [guard AND] (c1 = @p1 OR c2 = @p2 ...) over the given parameters (FLT-10, FLT-11).

    ``params`` maps column name -> value; ``None`` means "not supplied".
    With no parameter supplied the result is empty.
    """
    pred = any_equal(params)
    if guard is not None:
        pred = guard & pred
    return df.filter(pred)


def any_match_above_avg(df: DataFrame, params: dict[str, Any], value: str, order: list[str] | None = None) -> DataFrame:
    """FLT-10 AND ``value`` above its average over ``df``, sorted (FLT-12).

    All other columns follow as tie-breakers, so the order is total and a
    value that many rows share spreads over several sort partitions.
    """
    out = df.filter((F.col(value) > avg_of(df, value)) & any_equal(params))
    first = order or [value]
    return out.orderBy(*first, *[c for c in df.columns if c not in first])


def procedure(view: DataFrame, columns: list[str], guard: Column | None = None):
    """Build a search procedure over ``view`` with one optional keyword
    parameter per column (PRM-1); call it with any subset (PRM-2)."""

    def run(**params: Any) -> DataFrame:
        unknown = set(params) - set(columns)
        if unknown:
            raise TypeError(f"unknown parameters: {sorted(unknown)}")
        return any_match(view.select(*columns), params, guard)

    return run


def sql_procedure(view: DataFrame, name: str, columns: list[str], guard_sql: str | None = None) -> str:
    """Register the procedure as a temporary SQL table function (PRM-1, SQL form).

    ``CREATE TEMPORARY FUNCTION name(p_<col> <type> DEFAULT NULL, ...)
    RETURNS TABLE (...)`` over a temp view of ``view``; call it with named
    arguments, e.g. ``SELECT * FROM name(p_category => 'Produce')``.  The
    function body is inlined by the analyzer, unsupplied (NULL) parameters
    fold away and the remaining predicate is pushed into the scan.
    Returns the function name.
    """
    spark = view.sparkSession
    view_name = f"{name}_source"
    view.select(*columns).createOrReplaceTempView(view_name)
    types = {f.name: f.dataType.simpleString() for f in view.schema}
    params = ", ".join(f"p_{c} {types[c]} DEFAULT NULL" for c in columns)
    returns = ", ".join(f"{c} {types[c]}" for c in columns)
    match = " OR ".join(f"{c} = {name}.p_{c}" for c in columns)
    where = f"({guard_sql}) AND ({match})" if guard_sql else match
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS TABLE ({returns}) "
        f"RETURN SELECT {', '.join(columns)} FROM {view_name} WHERE {where}"
    )
    return name
