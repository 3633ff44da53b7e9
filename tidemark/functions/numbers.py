"""Money casts, guarded ratios and repeatable rounding."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

__all__ = [
    "as_col", "cast_price", "count_rows", "half_up", "mean", "mean_of_means", "money_mean", "money_sum", "percent",
    "quotient", "ratio", "round_robin", "share_true",
]


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cast_price(c: Column | str, precision: int = 10, scale: int = 2) -> Column:
    return as_col(c).cast(DecimalType(precision, scale))


def count_rows() -> Column:
    return F.count(F.lit(1))


def half_up(c: Column, places: int = 2) -> Column:
    """Round half away from zero, as a decimal.

    A double goes by its first twelve decimals, so a quotient that lies on a tie but not exactly in binary is
    rounded like the tie. For quotients of sums use `quotient`, which does not round twice.
    """
    return F.round(c.cast(DecimalType(38, 12)), places).cast(DecimalType(28, places))


def quotient(top: Column, bottom: Column, places: int = 2) -> Column:
    """top / bottom rounded half away from zero, in whole numbers; NULL where the bottom is zero or NULL.

    Both sides may have six decimals and twenty digits before them; more raise in ANSI mode, which `tune` sets.
    """
    def units(c: Column) -> Column:
        return (c.cast(DecimalType(26, 6)) * F.lit(Decimal(10**6))).cast(DecimalType(32, 0))

    n, d = units(top), units(bottom)
    double = F.nullif(F.abs(d) * F.lit(Decimal(2)), F.lit(Decimal(0)))
    raised = F.abs(n) * F.lit(Decimal(2 * 10**places)) + F.abs(d)
    whole = ((raised - raised % double) / double).cast(DecimalType(36, 0))
    signed = F.when((n < 0) == (d < 0), whole).otherwise(-whole)
    return (signed * F.lit(Decimal(1).scaleb(-places))).cast(DecimalType(28, places))


def _amount(c: Column | str) -> Column:
    """Exact sum of amounts with four decimals below 10^14 each: ten-thousandths added as 64-bit integers, about three
    times as fast as a decimal buffer. Beyond 9*10^14 for a group it raises in ANSI mode."""
    units = (as_col(c).cast(DecimalType(18, 4)) * F.lit(10_000)).cast("long")
    return (F.sum(units).cast(DecimalType(19, 0)) * F.lit(Decimal("0.0001"))).cast(DecimalType(23, 4))


def money_sum(c: Column | str) -> Column:
    """Sum of amounts with up to four decimals, rounded once to cents."""
    return _amount(c).cast(DecimalType(28, 2))


def ratio(top: Column, bottom: Column, otherwise: object = None) -> Column:
    """top / bottom as a double; `otherwise` where the bottom is zero or NULL."""
    plain = top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))
    return plain if otherwise is None else F.coalesce(plain, F.lit(otherwise).cast("double"))


def percent(top: Column, bottom: Column, places: int = 2) -> Column:
    return quotient(top * F.lit(100), bottom, places)


def mean(c: Column | str, places: int | None = 2) -> Column:
    """Average over the non-NULL values: exact sum, one division, at most one rounding."""
    value = as_col(c)
    top, bottom = F.sum(value), F.count(value)
    return ratio(top, bottom) if places is None else quotient(top, bottom, places)


def money_mean(c: Column | str, places: int | None = 2) -> Column:
    """Average of amounts with up to four decimals."""
    top, bottom = _amount(c), F.count(as_col(c))
    return ratio(top, bottom) if places is None else quotient(top, bottom, places)


def mean_of_means(c: Column | str) -> Column:
    """Average of values that are themselves averages: they are added with twelve decimals, so the order of the rows
    does not matter, and the result is not rounded."""
    return mean(as_col(c).cast(DecimalType(22, 12)), None)


def share_true(flag: Column, places: int = 2) -> Column:
    """Percent of all rows on which the flag holds."""
    return percent(F.count_if(flag), F.count(F.lit(1)), places)


def round_robin(number: Column, slots: Column) -> Column:
    """1-based slot for a running number; `pmod` keeps negative numbers in range."""
    return F.pmod(number - F.lit(1), slots) + F.lit(1)
