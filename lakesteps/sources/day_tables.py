"""Tables in one folder per day, of which a refresh writes the days it changes and no others.

Days are dates; rows without one lie in a folder of their own, which every refresh replaces.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakesteps.operators.dedup import keep_last
from lakesteps.operators.merge import _total
from lakesteps.operators.reshape import pivot_last
from lakesteps.session import materialize
from lakesteps.sources.readers import path_exists

NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def stored_days(spark: SparkSession, path: str, date: str) -> list[Date | None]:
    """The days that have a folder, by their names alone."""
    place, fs = _folder(spark, path)
    if not fs.exists(place):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(place)]
    values = [n.removeprefix(f"{date}=") for n in names if n.startswith(f"{date}=")]
    return sorted((None if v == NO_DAY else Date.fromisoformat(v) for v in values), key=lambda d: (d is not None, d))


def among(date: str, days: Sequence[Date | None]) -> Column:
    """A filter that Spark turns into a list of folders, that of rows without a day included."""
    some = [d for d in days if d is not None]
    tests = ([F.col(date).isin(some)] if some else []) + ([F.col(date).isNull()] if None in days else [])
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def read_days(spark: SparkSession, path: str, schema: T.StructType, days: Sequence[Date | None] | None = None,
              date: str | None = None) -> DataFrame:
    """The table, or its rows of ``days``. Columns that older files lack are NULL; a table that was
    never written is empty."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(path).select(*(f"`{c}`" for c in schema.names))
    return rows if days is None else rows.where(among(date, days))


def _put(rows: DataFrame, path: str, date: str, touched: Sequence[Date | None]) -> None:
    """Write the days of ``rows`` over those stored; of ``touched`` days without rows, the folder goes.

    A write that fails leaves each day as it was or as it will be; the same refresh can be run again.
    """
    spark = rows.sparkSession
    held = {r[0] for r in rows.select(date).distinct().collect()}  # one value per calendar day
    if held:
        # a day's rows go to few files, but one that holds very many is split
        (rows.hint("rebalance", F.col(date)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(date).parquet(path))
    gone = [d for d in touched if d not in held]
    for day in set(gone) & set(stored_days(spark, path, date)):
        place, fs = _folder(spark, f"{path.rstrip('/')}/{date}={NO_DAY if day is None else day.isoformat()}")
        fs.delete(place, True)


def refresh_days(new: DataFrame, path: str, date: str, start: Date, keys: Sequence[str],
                 ordinal: Sequence[str] = ()) -> list[Date | None]:
    """``overwrite_window`` on a table stored by day: the same rows, but only changed days are written.

    Stored rows from ``start`` on give way to ``new``. New rows of earlier days replace stored ones of
    their key, for which only those days are read. ``keys`` must hold ``date``. Returns the days
    touched, those that have become empty included.
    """
    if date not in keys:
        raise ValueError("the keys of a day table hold its date")
    spark = new.sparkSession
    fresh = materialize(keep_last(new, keys, _total(new, ordinal, *keys)), "refresh-new")
    early = [r[0] for r in fresh.where(F.col(date) < F.lit(start)).select(date).distinct().collect()]
    stored = stored_days(spark, path, date)
    old_days = [d for d in early if d in set(stored)]
    rows = fresh
    if old_days:
        old = read_days(spark, path, new.schema, old_days, date)
        both = old.withColumn("_age", F.lit(0)).unionByName(fresh.withColumn("_age", F.lit(1)))
        # written before the days it is read from are written over
        rows = materialize(keep_last(both, keys, ["_age", *_total(new, ordinal, *keys)]).drop("_age"), "refresh-rows")
    window = [d for d in stored if d is None or d >= start]
    days = {r[0] for r in rows.select(date).distinct().collect()}
    _put(rows, path, date, window)
    return sorted(days | set(window), key=lambda d: (d is not None, d))


def patch_wide(spark: SparkSession, long_path: str, long_schema: T.StructType, wide_path: str,
               days: Sequence[Date | None], date: str, key: str, value: str, columns: Sequence[str],
               ordinal: Sequence[str] = ()) -> T.StructType:
    """Pivot the given days of a long day table anew into a wide one; returns the wide schema.

    Days that have no rows any more lose their folder. ``columns`` may grow from run to run: older
    days read NULL there until they are patched.
    """
    long = read_days(spark, long_path, long_schema, days, date)
    wide = pivot_last(long, date, key, value, columns, ordinal or [date])
    _put(wide, wide_path, date, days)
    return wide.schema
