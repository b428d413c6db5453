"""Grouped aggregates and set operations. All combine on the map side before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date as Date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

_FUNCTIONS = {
    "sum": F.sum, "max": F.max, "min": F.min, "avg": F.avg, "count": F.count,
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_by(df: DataFrame, keys: Mapping[str, Column], name: str = "n") -> DataFrame:
    """Rows per derived key: ``{key name: expression}``."""
    return df.groupBy(*[e.alias(k) for k, e in keys.items()]).agg(F.count(F.lit(1)).alias(name))


def rollup_spec(
    df: DataFrame, keys: Sequence[Column | str], spec: Mapping[str, tuple[str, Column | str]]
) -> DataFrame:
    """Several aggregates in one pass: ``{out: (function, column)}``.

    Flows are summed, levels take the maximum, rates the average.
    """
    return df.groupBy(*[_col(k) for k in keys]).agg(
        *[_FUNCTIONS[fn](_col(c)).alias(out) for out, (fn, c) in spec.items()]
    )


def class_counts(df: DataFrame, date: str, cls: str, classes: Sequence[str]) -> DataFrame:
    """Rows per date and class, one column per class, plus the total; dates without rows absent."""
    counts = [F.count_if(F.col(cls) == c).alias(c) for c in classes]
    total = F.count_if(F.col(cls).isin(list(classes))).alias("total")
    return df.groupBy(date).agg(*counts, total).where("total > 0")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).where(F.col(col).isNotNull()).distinct()


def high_water(df: DataFrame, col: str) -> Column:
    """The largest value as a scalar subquery, for use inside another query."""
    return df.agg(F.max(col)).scalar()


def high_water_value(df: DataFrame, col: str) -> Date | None:
    """The largest value itself: one row to the driver."""
    return df.agg(F.max(col)).first()[0]


def union_distinct(dfs: Sequence[DataFrame]) -> DataFrame:
    """Distinct rows of one-column inputs.

    Each input is made distinct first; the union then shuffles values, not rows.
    """
    return reduce(DataFrame.union, [df.distinct() for df in dfs]).distinct()


def union_all(dfs: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def left_join_all(spine: DataFrame, sides: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Left joins of sides that hold one row per key, so no row of the spine is repeated."""
    return reduce(lambda left, right: left.join(right, list(on), "left"), sides, spine)
