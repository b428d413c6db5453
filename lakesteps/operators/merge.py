"""Incremental merges. Each costs one shuffle on the key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date, timedelta

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lakesteps.operators.dedup import keep_first, keep_last, priority_union

# Fixed values of the incremental search-trend load.
INITIAL_START = Date(2020, 1, 1)
WINDOW_DAYS = 29


def merge_new_first(
    old: DataFrame,
    new: DataFrame,
    key: str,
    date: str,
    drop_blank_title: bool = False,
    title: str = "title",
    ordinal: Sequence[str] = (),
) -> DataFrame:
    """New rows before old rows, first row per key kept, so a new row replaces an old one.

    Without new rows the old rows stay as they are, repeated keys and blank titles included; a
    text date is parsed all the same. A date that does not parse becomes NULL. ``ordinal`` orders
    rows within one input; the other columns break its ties.
    """
    any_new = new.agg((F.count(F.lit(1)) > 0).alias("any")).scalar()
    rows = new.withColumn("_age", F.lit(0)).unionByName(old.withColumn("_age", F.lit(1)))
    merged = keep_first(rows.where(any_new), [key], ["_age", *_total(rows, ordinal, key)]).drop("_age")
    if drop_blank_title:
        merged = merged.where(F.col(title).isNotNull())
    merged = merged.unionByName(old.where(~any_new))
    if dict(merged.dtypes)[date] == "string":
        merged = merged.withColumn(date, F.try_to_date(date, "yyyy-MM-dd"))
    return merged


def overwrite_window(
    old: DataFrame,
    new: DataFrame,
    date: str,
    start: Column | Date,
    keys: Sequence[str],
    ordinal: Sequence[str] = (),
) -> DataFrame:
    """Old rows from ``start`` on give way to ``new``; the last row per key stays, the largest in
    ``ordinal`` and then in the other columns."""
    start = start if isinstance(start, Column) else F.lit(start)
    kept = old.where(F.col(date) < start)
    rows = kept.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)))
    return keep_last(rows, keys, ["_age", *_total(rows, ordinal, *keys)]).drop("_age")


def _total(df: DataFrame, ordinal: Sequence[str], *keys: str) -> list[str]:
    """``ordinal`` and then every other column that can be ordered, so that no tie is left open."""
    rest = [f.name for f in df.schema if f.name not in (*ordinal, *keys, "_age")
            and "map<" not in f.dataType.simpleString()]
    return [*ordinal, *rest]


def reprocess_window(
    mark: Date | None, today: Date, initial: Date = INITIAL_START, days: int = WINDOW_DAYS
) -> tuple[Date, Date]:
    """Dates to load again: everything without a mark, else from ``days`` before it."""
    return (initial if mark is None else mark - timedelta(days=days)), today


def backfill(
    archive: DataFrame,
    live: DataFrame,
    date: str,
    run_day: Date | Column,
    archive_lag: int = 3,
    live_days: int = 2,
    ordinal: Sequence[str] = (),
) -> DataFrame:
    """Archive rows up to ``run_day - archive_lag``, live rows of the last days; live wins."""
    today = run_day if isinstance(run_day, Column) else F.lit(run_day)
    settled = archive.where(F.col(date) <= F.date_sub(today, archive_lag))
    recent = live.where(F.col(date).between(F.date_sub(today, live_days), today))
    return priority_union([settled, recent], [date], _total(settled, ordinal, date))


def _exact(value: Column, kind: T.DataType) -> Column:
    """A value as text that differs wherever the value does: its length goes before it, NULL is
    told from empty, times keep their microseconds."""
    if isinstance(kind, T.TimestampType):
        text = F.unix_micros(value).cast("string")
    elif isinstance(kind, T.BinaryType):
        text = F.hex(value)
    else:
        text = value.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def new_or_changed(
    old: DataFrame, new: DataFrame, key: Sequence[str], ignore: Sequence[str] = ()
) -> DataFrame:
    """Rows of ``new`` that ``old`` lacks or holds with other values.

    Appending only these keeps a bronze table from growing by its whole history on each run.
    ``ignore`` names columns such as a load time that do not count as a change.
    """
    compared = [c for c in new.columns if c not in ignore and c not in key]

    types = {c: new.schema[c].dataType for c in compared}

    def digest(*values: Column) -> Column:
        # one digest per row, so that the stored side is shuffled as key and digest, not as rows
        return F.sha2(F.concat(F.lit(""), *[_exact(v, types[c]) for c, v in zip(compared, values)]), 256)

    # the stored side gets names of its own, so that both sides may come from one table
    seen = old.select(
        *[F.col(k).alias(f"_old_{k}") for k in key],
        digest(*[F.col(c).cast(types[c]) for c in compared]).alias("_old_digest"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_old_{k}")) for k in key]
    same.append(F.col("_digest") == F.col("_old_digest"))
    rows = new.withColumn("_digest", digest(*[F.col(c) for c in compared]))
    return rows.join(seen, same, "left_anti").drop("_digest")
