"""Exact-decimal money arithmetic (the T-SQL MONEY type).

MONEY is a 64-bit integer count of 1/10000 units, so its values reach
+-922,337,203,685,477.5807.  It is mapped to ``decimal(19,4)``, which holds
them all; a larger value raises an overflow error under ANSI mode rather
than wrapping.

Driver data stores prices as double; every money column is cast once with
``money`` and all arithmetic after that is exact decimal arithmetic.
Results are cast back to an explicit decimal type so the type does not
depend on Spark's precision-widening rules.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from relprep.fixed import ROUND_UP_ABOVE_CENTS

MONEY = DecimalType(19, 4)
# Sums of money keep 4 decimals but need headroom for many rows.
MONEY_SUM = DecimalType(38, 4)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """Cast to decimal(19,4)."""
    return _c(c).cast(MONEY)


def line_value(price: Column | str, quantity: Column | str) -> Column:
    """price x quantity as money (PRJ-2)."""
    return (money(price) * _c(quantity).cast("int")).cast(MONEY)


def safe_quotient(n: Column | str, d: Column | str) -> Column:
    """n / d as money; a zero divisor gives NULL instead of an error (PRJ-3)."""
    return (money(n) / F.nullif(money(d), F.lit(0).cast(MONEY))).cast(MONEY)


def _unscaled(c: Column | str) -> Column:
    """The money value in 1/10000 units as a long (exact: MONEY is a 64-bit count)."""
    return (money(c) * F.lit(10000)).cast("long")


def is_integral_quotient(n: Column | str, d: Column | str) -> Column:
    """True when n / d has no fraction, tested exactly as n % d = 0 (FLT-13).

    Both are money with the same scale, so n % d = 0 exactly when their
    unscaled values divide; the remainder is taken on longs (about twice
    as fast as a decimal remainder).  A zero divisor yields NULL, which
    every filter treats as false.
    """
    return (_unscaled(n) % F.nullif(_unscaled(d), F.lit(0).cast("long"))) == 0


def whole_part(c: Column | str) -> Column:
    """FLOOR of a money value, still money (PRJ-8, MTH-3)."""
    return F.floor(money(c)).cast(MONEY)


def cents_part(c: Column | str) -> Column:
    """(x - floor(x)) * 100 as money: the cents of a price (PRJ-8)."""
    m = money(c)
    return ((m - F.floor(m)) * 100).cast(MONEY)


def rounded_up(whole: Column | str, cents: Column | str, above: int = ROUND_UP_ABOVE_CENTS) -> Column:
    """whole + 1 when the cents exceed ``above``; NULL otherwise (PRJ-9)."""
    return F.when(_c(cents) > above, (_c(whole) + 1).cast(MONEY))


def floor_price(c: Column | str) -> Column:
    """Round a price down to a whole amount, kept as money (PRJ-10): 3.60 -> 3.00."""
    return F.floor(money(c)).cast(MONEY)


def discounted_units(quantity: Column | str, discount: Column | str) -> Column:
    """SUM(quantity x (1 - discount)) as decimal(18,4) (AGG-11 input).

    Narrow enough that money x units keeps all eight decimals
    (19 + 18 + 1 digits); an overflow raises.
    """
    return F.sum(_c(quantity).cast("int") * (F.lit(1).cast(MONEY) - money(discount))).cast(DecimalType(18, 4))


def round_money(c: Column | str, scale: int = 2, dtype: DecimalType = MONEY_SUM) -> Column:
    """ROUND(x, scale) half-up on decimals, then an explicit result type (MTH-4)."""
    return F.round(_c(c), scale).cast(dtype)
