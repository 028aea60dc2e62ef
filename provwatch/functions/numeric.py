"""Exact ratios, percentages and rounding.

Money and counts stay in decimals, so that a quotient which lies exactly on a rounding half goes the
right way. Only statistics that are floating point by nature (standard deviations, ranks) use doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OPERAND = "decimal(24,2)"


def quotient(numerator: Column, denominator: Column, factor: int = 1) -> Column:
    """``numerator * factor / denominator`` as a decimal; NULL for a zero or NULL denominator."""
    top = numerator.cast(_OPERAND)
    if factor != 1:
        top = top * F.lit(factor)
    return F.try_divide(top, denominator.cast(_OPERAND))


def ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    return F.round(quotient(numerator, denominator), digits)


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(quotient(part, whole, 100), digits)


def ratio_or_zero(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """Ratio where the denominator is positive, else 0 (also for a NULL denominator)."""
    return F.when(denominator > 0, ratio(numerator, denominator, digits)).otherwise(F.lit(0))


def percentage_or_zero(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.when(whole > 0, percentage(part, whole, digits)).otherwise(F.lit(0))


def ratio_or_null(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    return F.when(denominator > 0, ratio(numerator, denominator, digits))


def pct_change(value: Column, base: Column, digits: int = 2) -> Column:
    """Change of ``value`` against a positive ``base`` in percent; NULL otherwise."""
    return F.when(base > 0, percentage(value - base, base, digits))


def round_half_away(value: Column, digits: int) -> Column:
    """Round a double half away from zero with one formula that does not depend on text conversion."""
    power = float(10**digits)
    magnitude = F.floor(F.abs(value) * F.lit(power) + F.lit(0.5)) / F.lit(power)
    # Adding 0.0 turns a negative zero into a plain one.
    return F.signum(value) * magnitude + F.lit(0.0)


def flag_count(*flags: Column) -> Column:
    """How many of the conditions hold; NULL conditions count as 0."""
    total = F.lit(0)
    for flag in flags:
        total = total + F.coalesce(flag, F.lit(False)).cast("int")
    return total
