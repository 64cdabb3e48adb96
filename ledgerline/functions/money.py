"""Money and ratio expressions.

Money is ``decimal(18,4)``; rates ``decimal(18,6)``; stored ratios
``decimal(6,5)``. Everything rounded for reports uses two decimals, half away
from zero (Spark's HALF_UP on decimals), and is typed ``decimal(20,2)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"
MONEY_SUM = "decimal(28,4)"  # a sum of money values, as Spark types sum(decimal(18,4))
RATE = "decimal(18,6)"
RATIO = "decimal(6,5)"
REPORT = "decimal(20,2)"
COUNT = "decimal(18,0)"


def _hundred() -> Column:
    return F.lit(100).cast("decimal(3,0)")


def half_up_ratio(num: Column, den: Column) -> Column:
    """``num / den`` stored as ``decimal(6,5)``.

    Integer division in Spark yields a double; the cast rounds half up. A
    ratio of 10 or more cannot be stored and becomes NULL (the constraint
    report flags every ratio outside [0, 1]); so does a zero denominator.
    """
    return F.try_divide(num, den).try_cast(RATIO)


def round2(value: Column) -> Column:
    """``ROUND(value, 2)`` typed for reports."""
    return F.round(value, 2).cast(REPORT)


def pct_2dp(num: Column, den: Column, counts: bool = True) -> Column:
    """``ROUND(num / NULLIF(den, 0) * 100, 2)`` in decimal arithmetic, NULL when ``den`` is 0.

    Counts are widened to ``decimal(18,0)`` and multiplied by a ``decimal(3,0)``
    hundred, which keeps the quotient at 16 decimal places: far below the
    distance between a ratio of counts and a rounding tie, so the result is the
    exactly rounded percentage (a double quotient would not be). Money needs
    more digits than a decimal quotient has: there the hundredths of a percent
    are an integral division of (2 * 10000 * num + den) by (2 * den), which is
    exact.
    """
    if counts:
        return round2(num.cast(COUNT) * _hundred() / F.nullif(den, F.lit(0)).cast(COUNT))
    n, d = F.abs(num.cast(MONEY_SUM)), F.abs(F.nullif(den, F.lit(0)).cast(MONEY_SUM))
    units = F.call_function("div", n * F.lit(20000).cast("decimal(5,0)") + d, d * F.lit(2).cast("decimal(1,0)"))
    signed = F.when((num < 0) != (den < 0), -units).otherwise(units)
    return (signed.cast(COUNT) * F.lit("0.01").cast("decimal(3,2)")).cast(REPORT)


def count_ratio(num: Column, den: Column) -> Column:
    """``num / NULLIF(den, 0)`` of two counts as an exact-enough decimal (20 places)."""
    return num.cast(COUNT) / F.nullif(den, F.lit(0)).cast(COUNT)


def exceeds_ratio(num: Column, den: Column, threshold: str) -> Column:
    """``num / NULLIF(den, 0) > threshold`` decided exactly, without dividing.

    NULL when ``den`` is 0, as the division would be.
    """
    t = F.lit(threshold).cast("decimal(10,4)")
    return F.when(den > 0, num > den * t).when(den < 0, num < den * t)
