"""Casts and divisions that give NULL instead of an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def safe_double(text: Column) -> Column:
    return text.try_cast("double")


def safe_int(text: Column, to: str = "int") -> Column:
    """Whole number from text such as ``'1.0'``; halves round away from zero, garbage is NULL."""
    return F.round(text.try_cast("double")).try_cast(to)


def code_between(text: Column, low: int, high: int) -> Column:
    """``safe_int(text).between(low, high)`` for 0 < low, without the rounding."""
    number = text.try_cast("double")
    return (number >= low - 0.5) & (number < high + 0.5)


def parse_decimal(text: Column) -> Column:
    """Number from text with a decimal comma or point."""
    return F.replace(text.cast("string"), F.lit(","), F.lit(".")).try_cast("double")


def safe_divide(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator, F.nullif(denominator, F.lit(0)))


def steady_round(value: Column, digits: int) -> Column:
    """Rounding for sums and means of doubles, whose last bits depend on the order of the rows.

    Six digits beyond the wanted ones are settled first, so the order cannot tip a half.
    """
    return F.round(F.round(value, digits + 6), digits)
