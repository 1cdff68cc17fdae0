"""Ratio, level and error arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from macrotide.functions.clean import _col


def ratio_change(x: Column | str, base: Column | str) -> Column:
    """``x / base - 1``; NULL for a missing or zero base."""
    return F.try_divide(_col(x), _col(base)) - F.lit(1.0)


def pair_mean(a: Column | str, b: Column | str) -> Column:
    """Mean of two values, NULL when either is missing."""
    return (_col(a) + _col(b)) / F.lit(2.0)


def level_from_change(previous: Column | str, change: Column | str) -> Column:
    return _col(previous) * (F.lit(1.0) + _col(change))


def residual(actual: Column | str, predicted: Column | str) -> Column:
    return _col(actual) - _col(predicted)


def percent(c: Column | str) -> Column:
    return _col(c) * F.lit(100.0)


def is_finite(c: Column | str) -> Column:
    """True for a present number that is neither NaN nor infinite."""
    v = _col(c)
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))
