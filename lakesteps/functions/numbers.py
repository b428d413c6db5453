"""Numeric and conditional expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F


def to_long(c: Column) -> Column:
    """Cast to an integer, rounding halves away from zero (Spark alone would truncate)."""
    return F.round(c).cast("bigint")


def default(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value))


def fallback_mean(mean: Column, high: Column, low: Column, digits: int = 1) -> Column:
    """The mean, else the middle of high and low."""
    return F.round(F.coalesce(mean, (high + low) / 2), digits)


def total(*cols: Column) -> Column:
    """Sum of cleaned parts; NULL counts as 0."""
    return reduce(add, [default(c, 0) for c in cols])


def first_match(cases: Sequence[tuple[Column, object]], otherwise=None) -> Column:
    """Value of the first condition that holds."""
    chain = None
    for condition, value in cases:
        value = value if isinstance(value, Column) else F.lit(value)
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    otherwise = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return otherwise if chain is None else chain.otherwise(otherwise)


def band(c: Column, thresholds: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first threshold reached. NULL reaches none and gets ``otherwise``."""
    return first_match([(c >= limit, label) for limit, label in thresholds], otherwise)


def weighted_index(weights: Mapping[str, float], digits: int = 2) -> Column:
    """Rounded weighted sum of columns; NULL as soon as one part is NULL."""
    return F.round(reduce(add, [F.col(c) * F.lit(w) for c, w in weights.items()]), digits)


def mean_of(*cols: Column, scale: float = 1.0) -> Column:
    return reduce(add, cols) / F.lit(len(cols)) * F.lit(scale)


def share(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage of ``whole``; 0 where it is NULL or 0."""
    ratio = F.try_divide(part, F.nullif(whole, F.lit(0)))
    return F.round(F.coalesce(ratio, F.lit(0.0)) * 100, digits)


def count_where(condition: Column) -> Column:
    """Rows where the condition holds; NULL over no rows, as a SUM over CASE gives."""
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)))
