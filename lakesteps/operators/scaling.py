"""Whole-table statistics, min-max scaling and what-if variants."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def global_stats(df: DataFrame, cols: Sequence[str], fns: Sequence[str] = ("min", "max")) -> Column:
    """Statistics over the whole table as one struct-valued scalar subquery.

    ``MIN(x) OVER ()`` would move every row into one task; this aggregates on the map side and
    hands one row back to the scan.
    """
    pick = {"min": F.min, "max": F.max}
    fields = [pick[fn](c).alias(f"{fn}_{c}") for c in cols for fn in fns]
    return df.agg(F.struct(*fields)).scalar()


def with_global_stats(
    df: DataFrame, cols: Sequence[str], fns: Sequence[str] = ("min", "max")
) -> DataFrame:
    """``{fn}_{col}`` columns beside every row."""
    stats = global_stats(df, cols, fns)
    names = [f"{fn}_{c}" for c in cols for fn in fns]
    rows = df.withColumn("_stats", stats)
    return rows.select(*df.columns, *[F.col(f"_stats.{n}").alias(n) for n in names])


def minmax_scale(
    df: DataFrame,
    cols: Mapping[str, str],
    scale: float = 100.0,
    null_to: float | None = None,
    invert: Sequence[str] = (),
) -> DataFrame:
    """Add ``{out: col}`` scaled to 0..``scale``.

    A NULL value or a constant column gives NULL, or ``null_to`` where that is set. An output
    named in ``invert`` is ``1 - x`` before scaling. The input is read twice, the first time for the
    scaled columns only; write a costly one first.
    """
    source = list(dict.fromkeys(cols.values()))
    rows = df.withColumn("_stats", global_stats(df, source))
    scaled = {}
    for out, c in cols.items():
        low, high = F.col(f"_stats.min_{c}"), F.col(f"_stats.max_{c}")
        x = F.try_divide(F.col(c) - low, F.nullif(high - low, F.lit(0)))
        if null_to is not None:
            x = F.coalesce(x, F.lit(float(null_to)))
        if out in invert:
            x = F.lit(1.0) - x
        scaled[out] = x * F.lit(scale)
    return rows.withColumns(scaled).drop("_stats")


def scenarios(
    df: DataFrame,
    variants: Mapping[str, Mapping[str, float]],
    weights: Mapping[str, float],
    index: str,
    ids: Sequence[str],
    digits: int = 2,
) -> DataFrame:
    """One row per input row and variant, from one scan.

    A variant multiplies columns and recomputes the index from them; a variant without factors
    keeps the stored index. Values are not capped.
    """
    structs = []
    for name, factors in variants.items():
        values = {c: F.col(c) * F.lit(factors[c]) if c in factors else F.col(c) for c in weights}
        if factors:
            total = None
            for c, w in weights.items():
                term = values[c] * F.lit(w)
                total = term if total is None else total + term
            new_index = F.round(total, digits)
        else:
            new_index = F.col(index)
        structs.append(F.struct(
            F.lit(name).alias("scenario"), new_index.alias(index),
            *[v.alias(c) for c, v in values.items()],
        ))
    return df.select(*ids, F.inline(F.array(*structs)))
