"""Rounding, ratios and clipping with fixed rules for nulls and ties."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def amount(col) -> Column:
    """A decimal sum as a double with two places, the form in which results show money."""
    return F.round(col, 2).cast("double")


def ratio(num: Column, den: Column, places: int = 2) -> Column:
    """Decimal quotient rounded half up; null where the denominator is zero or null."""
    return F.round(num / F.nullif(den, F.lit(0).cast("long")), places).cast("double")


def quotient(num: Column, den: Column) -> Column:
    """Unrounded double quotient of two exact numbers; null where the denominator is zero."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def mean(col) -> Column:
    """Mean as exact sum over count, so that the order of the rows cannot change it."""
    col = F.col(col) if isinstance(col, str) else col
    return quotient(F.sum(col), F.count(col))


def percent(part: Column, whole: Column, places: int = 1) -> Column:
    """Share in percent, rounded half even."""
    return F.bround(quotient(part, whole) * 100, places)


def clip(col: Column, low=None, high=None) -> Column:
    """Clip to bounds and keep null as null (`greatest` and `least` would skip it)."""
    kept = col
    if low is not None:
        kept = F.greatest(kept, low if isinstance(low, Column) else F.lit(low))
    if high is not None:
        kept = F.least(kept, high if isinstance(high, Column) else F.lit(high))
    return F.when(col.isNotNull(), kept)


def whole_division(num: Column, den: Column) -> Column:
    return F.call_function("div", num, den)
