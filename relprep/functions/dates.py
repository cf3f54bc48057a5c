"""Date adapters with T-SQL semantics (DAT-1..4)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(c: Column | str) -> Column:
    """Timestamp (or text) to DATE."""
    return _c(c).cast("date")


def today() -> Column:
    """GETDATE() as a date; fixed for the whole query (DAT-1)."""
    return F.current_date()


def now() -> Column:
    """GETDATE() as a timestamp; fixed for the whole query (DAT-1)."""
    return F.current_timestamp()


def day_diff(start: Column | str, end: Column | str) -> Column:
    """DATEDIFF(DAY, start, end): signed day count, NULL-propagating (DAT-2)."""
    return F.datediff(as_date(end), as_date(start))


def year_diff(start: Column | str, end: Column | str) -> Column:
    """DATEDIFF(YEAR, start, end): calendar-year boundaries crossed (DAT-3).

    31 Dec 2019 -> 1 Jan 2020 is 1, unlike a count of full years.
    """
    return F.year(_c(end)) - F.year(_c(start))


def completed_years(start: Column | str, asof: Column | str | _dt.date) -> Column:
    """Whole years elapsed from ``start`` to ``asof`` (DAT-4, years of service).

    The anniversary counts on its day: 2000-06-30 -> 2001-06-30 is 1.
    """
    a = F.lit(asof).cast("date") if isinstance(asof, _dt.date) else as_date(asof)
    s = as_date(start)
    before_anniversary = (F.month(a) * 100 + F.dayofmonth(a)) < (F.month(s) * 100 + F.dayofmonth(s))
    return F.year(a) - F.year(s) - F.when(before_anniversary, 1).otherwise(0)
