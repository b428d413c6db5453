"""Keep one row per key, always under a stated order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "_rank"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def keep_one(
    df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str]
) -> DataFrame:
    """The first row per key in ``order``; the order must leave no ties.

    Spark plans a ``WindowGroupLimit`` before the shuffle: each map task sends one row per key,
    so a key that holds a third of the table costs one row per task and not one huge group.
    """
    window = Window.partitionBy(*[_col(k) for k in keys]).orderBy(*[_col(o) for o in order])
    return df.withColumn(_RANK, F.row_number().over(window)).where(f"{_RANK} = 1").drop(_RANK)


def keep_first(df: DataFrame, keys: Sequence[str], ordinal: Sequence[str]) -> DataFrame:
    """First row per key in input order, the order being the ``ordinal`` columns."""
    return keep_one(df, keys, [F.col(o).asc_nulls_first() for o in ordinal])


def keep_last(df: DataFrame, keys: Sequence[str], ordinal: Sequence[str]) -> DataFrame:
    """Last row per key in input order."""
    return keep_one(df, keys, [F.col(o).desc_nulls_last() for o in ordinal])


def priority_union(
    dfs: Sequence[DataFrame], keys: Sequence[str], ordinal: Sequence[str] = ()
) -> DataFrame:
    """Union of inputs given low to high; per key the row of the highest input wins.

    ``ordinal`` orders rows of one input that share a key; the last one wins.
    """
    tagged = [df.withColumn("_priority", F.lit(i)) for i, df in enumerate(dfs)]
    rows = reduce(DataFrame.unionByName, tagged)
    return keep_last(rows, keys, ["_priority", *ordinal]).drop("_priority")
