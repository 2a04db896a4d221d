"""Formatting expressions for ids and report cells."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def padded_id(number: Column, prefix: str = "", width: int = 4) -> Column:
    """``prefix`` and a zero-padded number; longer numbers are kept whole."""
    return F.format_string(f"{prefix}%0{width}d", number.cast("bigint"))


def prefixed(name: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), name)


def percent(share: Column, digits: int = 1) -> Column:
    """0.9583 -> '95.8%'."""
    return F.concat(F.format_number(share * 100, digits), F.lit("%"))


def thousands(value: Column, unit: str = "k") -> Column:
    """95964.21 -> '96k'."""
    return F.concat(F.format_number(value / 1000, 0), F.lit(unit))


def grouped(value: Column, digits: int = 0) -> Column:
    """1432552 -> '1,432,552'."""
    return F.format_number(value, digits)
