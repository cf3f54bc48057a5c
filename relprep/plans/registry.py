"""Registry pairing each check query with its independent SQL oracle.

``@check("q_name", sql=...)`` registers a ``(spark, base) -> DataFrame``
function.  ``sql`` is ANSI SQL for DuckDB over the driver tables (views
``region nation customer ... conversations``); ``sql=None`` marks a query
whose output depends on the clock and gets a rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Check:
    name: str
    fn: QueryFn
    sql: str | None
    operators: tuple[str, ...]


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None, operators: tuple[str, ...] = ()):
    def deco(fn: QueryFn) -> QueryFn:
        if name in CHECKS:
            raise ValueError(f"duplicate check {name}")
        CHECKS[name] = Check(name, fn, sql, operators)
        return fn

    return deco
