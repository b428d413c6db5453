"""Wide/long, arrays to rows, intervals to days."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def unpivot_long(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str],
    key: str,
    value: str,
    drop_null: bool = True,
) -> DataFrame:
    """One row per id and value column."""
    long = df.unpivot([F.col(c) for c in ids], [F.col(c) for c in values], key, value)
    return long.where(F.col(value).isNotNull()) if drop_null else long


def pivot_last(
    df: DataFrame,
    index: str,
    column: str,
    value: str,
    values: Sequence[str],
    ordinal: Sequence[str],
) -> DataFrame:
    """One row per ``index``, one column per value of ``column``, holding its last value.

    ``values`` is stated by the caller, which saves the job that would look for them and keeps
    the schema fixed. One conditional aggregate per column, partial on the map side.
    """
    # a single column keeps the aggregate a hash aggregate; a struct would make it sort
    at = F.col(ordinal[0]) if len(ordinal) == 1 else F.struct(*ordinal)
    wide = [
        F.max_by(F.when(F.col(column) == v, F.col(value)),
                 F.when((F.col(column) == v) & F.col(value).isNotNull(), at)).alias(v)
        for v in values
    ]
    return df.groupBy(index).agg(*wide)


def outer_join_all(dfs: Sequence[DataFrame], on: str, anchor: str | None = None) -> DataFrame:
    """Full outer join of frames that are unique on ``on``, with one shuffle for all of them.

    A chain of joins would shuffle once per frame, because the merged key of one join is not the
    partitioning of the next. Here the frames are stacked, and one aggregate folds the rows of a
    key. ``anchor`` is a column all frames share; it is taken from the first frame only, as is
    any other repeated column. A frame that repeats a key is an error, as its rows would mix.
    """
    owner: dict[str, int] = {}
    for i, df in enumerate(dfs):
        for c in df.columns:
            if c != on and not (c == anchor and i > 0):
                owner.setdefault(c, i)
    stacked = [
        df.select(on, *[c for c in df.columns if owner.get(c) == i], F.lit(i).alias("_frame"))
        for i, df in enumerate(dfs)
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stacked)
    counts = [F.count_if(F.col("_frame") == i).alias(f"_n{i}") for i in range(len(dfs))]
    folded = rows.groupBy(on).agg(*[F.max(c).alias(c) for c in owner], *counts)
    most = reduce(F.greatest, (F.col(f"_n{i}") for i in range(1, len(dfs))), F.col("_n0"))
    key = F.when(most <= 1, F.col(on)).otherwise(F.raise_error(F.concat(
        F.lit(f"repeated {on}: "), F.coalesce(F.col(on).cast("string"), F.lit("NULL")))))
    return folded.select(key.alias(on), *owner)


def explode_lateral(df: DataFrame, array: Column, name: str) -> DataFrame:
    """One row per array element; no row for an empty or NULL array."""
    return df.withColumn(name, F.explode(array))


def explode_days(df: DataFrame, start: str, end: str, name: str) -> DataFrame:
    """One row per day from ``start`` to ``end``, a NULL end meaning one day.

    A reversed interval gives no row; ``sequence`` alone would fail on it.
    """
    last = F.coalesce(F.col(end), F.col(start))
    days = F.when(F.col(start) <= last, F.sequence(F.col(start), last))
    return df.withColumn(name, F.explode(days))


def explode_months(
    df: DataFrame, start: str, end: str, month: str = "month_start", days: str = "days"
) -> DataFrame:
    """One row per month an interval touches, with the number of its days in that month.

    For counts per month this says the same as ``explode_days`` with about a thirtieth of the
    rows.
    """
    last = F.coalesce(F.col(end), F.col(start))
    months = F.when(
        F.col(start) <= last,
        F.sequence(F.trunc(start, "month"), F.trunc(last, "month"), F.expr("interval 1 month")),
    )
    rows = df.withColumn(month, F.explode(months))
    inside = F.datediff(F.least(last, F.last_day(month)), F.greatest(F.col(start), F.col(month)))
    return rows.withColumn(days, (inside + 1).cast("bigint"))


def zip_arrays_to_rows(
    df: DataFrame,
    arrays: Mapping[str, Column],
    literals: Mapping[str, object] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per index of equally long arrays; unequal or missing arrays are an error."""
    named = df.select(*keep, *[a.alias(name) for name, a in arrays.items()])
    sizes = [F.size(name) for name in arrays]
    same = reduce(lambda a, b: a & b, [sizes[0] == s for s in sizes[1:]], sizes[0].isNotNull())
    zipped = F.when(same, F.arrays_zip(*arrays)).otherwise(
        F.raise_error(F.lit("arrays to zip are missing or differ in length"))
    )
    out = named.select(*keep, F.inline(zipped))
    return out.withColumns({k: F.lit(v) for k, v in (literals or {}).items()}) if literals else out
