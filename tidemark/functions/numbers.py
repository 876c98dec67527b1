"""Arithmetic that keeps one meaning for zero, negative and missing input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, NULL where bottom is zero."""
    return F.try_divide(top, bottom)


def growth(new: Column, old: Column) -> Column:
    """new / old - 1."""
    return ratio(new, old) - F.lit(1.0)


def log_or_null(x: Column) -> Column:
    return F.when(x > 0, F.ln(x))


def to_long(x: Column) -> Column:
    """Rounds before the cast, which alone would truncate."""
    return F.round(x.cast("double"), 0).cast("long")


def best_growth(close: Column, first: Column) -> Column:
    """max(close / first - 1) when ``first`` is one value per group, as one aggregate."""
    up = F.max(close)
    down = F.min(close)
    return growth(F.when(first >= 0, up).otherwise(down), first)
