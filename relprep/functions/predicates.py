"""Predicates (FLT-*) as Column expressions.

Case rule: pattern matches are case-sensitive by default; ``ignore_case``
switches to ``ilike``.  Character classes (``[0-9]``, ``[A-Z]``) have no
``LIKE`` form in Spark and use ``rlike``.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from relprep.functions.text import charindex, left


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def like(c: Column | str, pattern: str, ignore_case: bool = False) -> Column:
    """SQL LIKE with ``%`` and ``_`` (FLT-7)."""
    return _c(c).ilike(pattern) if ignore_case else _c(c).like(pattern)


def not_like(c: Column | str, pattern: str, ignore_case: bool = False) -> Column:
    return ~like(c, pattern, ignore_case)


def starts_with_digit(c: Column | str) -> Column:
    """LEFT(s,1) LIKE '[0-9]' (FLT-8)."""
    return _c(c).rlike("^[0-9]")


def has_letter(c: Column | str) -> Column:
    """s LIKE '%[A-Z]%' under a case-insensitive collation (FLT-8, UPD-4)."""
    return _c(c).rlike("[A-Za-z]")


def is_single_word(c: Column | str) -> Column:
    """No space and no slash (FLT-14)."""
    return (charindex(" ", c) == 0) & (charindex("/", c) == 0)


def prefix_in(c: Column | str, digits: list[str] | tuple[str, ...]) -> Column:
    """LEFT(s, 1) IN (...) compared as text (FLT-5).

    Comparing with integer literals would cast every first character to a
    number, which fails under ANSI mode for non-digits.
    """
    return left(c, 1).isin(*[str(d) for d in digits])


def any_equal(params: dict[str, Any]) -> Column:
    """OR over ``column = value`` for the supplied (non-None) values (FLT-10).

    ``WHERE a = @a OR b = @b`` with every parameter NULL matches nothing, so
    an empty fold is ``false``.  Absent parameters never enter the plan.
    """
    terms = [F.col(name) == F.lit(value) for name, value in params.items() if value is not None]
    if not terms:
        return F.lit(False)
    return reduce(lambda a, b: a | b, terms)


def all_of(*preds: Column) -> Column:
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)
