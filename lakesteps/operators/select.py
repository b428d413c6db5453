"""Projection and row selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from lakesteps.functions.text import contains_any


def project(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Select, rename and reorder: ``{new: old}``."""
    return df.select(*[F.col(old).alias(new) for new, old in names.items()])


def with_lineage(
    df: DataFrame, source: str, source_system: str, crawl_time: Column | None = None
) -> DataFrame:
    return df.withColumns({
        "source": F.lit(source),
        "source_system": F.lit(source_system),
        "crawl_time": F.current_timestamp() if crawl_time is None else crawl_time,
    })


def with_processed_at(df: DataFrame, name: str = "dbt_processed_at") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows in which every named column has a value.

    Spelled out as ``IS NOT NULL`` conditions because these reach the Parquet scan, which
    ``dropna`` does not.
    """
    return df.where(reduce(and_, [F.col(c).isNotNull() for c in cols]))


def require_text(df: DataFrame, col: str) -> DataFrame:
    """Rows whose text is neither NULL nor empty."""
    return df.where(F.col(col) != "")


def keep_containing(df: DataFrame, cols: Sequence[str], terms: Sequence[str]) -> DataFrame:
    """Rows whose joined texts contain any of the terms."""
    return df.where(contains_any([F.col(c) for c in cols], terms))


def take_until_marker(
    df: DataFrame, order: Sequence[str], key: str, marker, descending: bool = True
) -> DataFrame:
    """Rows strictly before the first row whose ``key`` equals ``marker``; all if there is none.

    The cut is one row, found by a partial aggregate and used as a scalar subquery, so nothing
    is sorted or shuffled but that row.
    """
    position = F.struct(*order)
    first = F.max(position) if descending else F.min(position)
    cut = df.where(F.col(key) == F.lit(marker)).agg(first).scalar()
    before = position > cut if descending else position < cut
    return df.where(cut.isNull() | before)


def newest_first(df: DataFrame, date: str, *ties: str) -> DataFrame:
    return df.orderBy(F.col(date).desc_nulls_last(), *ties)


def newest(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The one row that comes first in newest-first order."""
    top = F.max_by(F.struct(*df.columns), F.struct(*order)).alias("row")
    return df.agg(top).where("row is not null").select("row.*")


def unique_columns(df: DataFrame) -> DataFrame:
    """Only the first of several columns with one name."""
    names, positions = [], []
    for i, name in enumerate(df.columns):
        if name not in names:
            names.append(name)
            positions.append(i)
    if len(names) == len(df.columns):
        return df
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))]).select(
        *[F.col(f"_{i}").alias(name) for i, name in zip(positions, names)]
    )
