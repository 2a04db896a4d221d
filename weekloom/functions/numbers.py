"""Numeric expressions: ratios that never divide by zero, order-free sums, rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def floored_ratio(num: Column, den: Column, floor: float = 1) -> Column:
    """``num / den`` with the denominator raised to at least ``floor``."""
    return num / F.greatest(den, F.lit(floor))


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den``, NULL where the denominator is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def minor_units(value: Column, scale: int) -> Column:
    """A fixed-point number as whole minor units (cents for scale 2)."""
    return F.rint(value * F.lit(10**scale)).cast("bigint")


def exact_sum(value: Column, scale: int | None) -> Column:
    """Sum that gives the same double for any row order, if ``scale`` is known.

    Whole minor units are added as integers and divided once at the end. This
    stays inside the generated hash aggregation, which decimals of more than 18
    digits do not.
    """
    if scale is None:
        return F.sum(value)
    return F.sum(minor_units(value, scale)) / F.lit(float(10**scale))


def rounded(value: Column, digits: int, half_even: bool = False) -> Column:
    """Half-up rounding, or half-even as numeric Python libraries do it."""
    return F.bround(value, digits) if half_even else F.round(value, digits)


def truncated(value: Column) -> Column:
    """Whole part, towards zero."""
    return value.cast("bigint")


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Value held inside [low, high]; either end may be open."""
    out = value if high is None else F.least(value, F.lit(high))
    return out if low is None else F.greatest(out, F.lit(low))
