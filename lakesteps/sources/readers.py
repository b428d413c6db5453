"""File readers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakesteps.operators.quality import missing_columns
from lakesteps.operators.rollup import union_all


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def _csv(spark: SparkSession, sep: str):
    """Quoted values may hold line breaks, so a file is one task: many files, not large ones, give
    parallel reads. Each file's own header must name the columns in the order they are bound in;
    a file that differs is an error, as its values would land in the wrong columns."""
    return (
        spark.read.option("header", True).option("sep", sep).option("multiLine", True)
        .option("enforceSchema", False)
        .option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
    )


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ","
) -> DataFrame:
    """Delimited text whose header names the columns of ``schema``, in order. A BOM is skipped."""
    return _csv(spark, sep).schema(schema).csv(path)


def read_typed_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = ",",
    ignore_unknown: bool = True,
    date_cols: Sequence[str] = (),
    strict: bool = True,
) -> DataFrame:
    """CSV bound to ``schema`` by header name.

    Columns the schema does not know are ignored, columns the file lacks are NULL. A value that
    does not fit its type is an error, or NULL when ``strict`` is off. ``date_cols`` names date
    columns where bad text is NULL in any case.
    """
    raw = _csv(spark, sep).csv(path)
    unknown = [c for c in raw.columns if c not in schema.names]
    if unknown and not ignore_unknown:
        raise ValueError(f"unknown columns in {path}: {unknown}")
    out = []
    for f in schema.fields:
        if f.name not in raw.columns:
            value = F.lit(None).cast(f.dataType)
        elif f.name in date_cols:
            value = F.try_to_date(f"`{f.name}`", "yyyy-MM-dd")
        elif strict:
            value = F.col(f"`{f.name}`").cast(f.dataType)
        else:
            value = F.col(f"`{f.name}`").try_cast(f.dataType)
        out.append(value.alias(f.name))
    return raw.select(*out)


def read_inferred_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV with guessed types. Costs one more pass over the file; prefer a schema."""
    return _csv(spark, sep).option("inferSchema", True).csv(path)


def union_feeds(
    spark: SparkSession, paths: Sequence[str], required: Sequence[str], sep: str = ","
) -> tuple[DataFrame | None, list[tuple[str, list[str]]]]:
    """Text columns of all usable feeds, and the feeds rejected with the columns they lack.

    A missing or empty file is skipped. The rows carry their input order for later keep-first
    steps: ``_feed`` is the place in ``paths``, ``_line`` the file, by name where that is a folder,
    and a number that rises within it. Both are set by the scan itself, before any shuffle.
    """
    frames, rejected = [], []
    for i, path in enumerate(paths):
        if not path_exists(spark, path):
            continue
        feed = _csv(spark, sep).csv(path)
        if not feed.columns or feed.isEmpty():
            continue
        missing = missing_columns(feed, required)
        if missing:
            rejected.append((path, missing))
        else:
            line = F.struct(F.col("_metadata.file_path").alias("file"),
                            F.monotonically_increasing_id().alias("row"))
            frames.append(feed.withColumns({"_feed": F.lit(i), "_line": line}))
    return (union_all(frames, allow_missing=True) if frames else None), rejected


def read_partition(spark: SparkSession, path: str, day: Date, column: str = "ds") -> DataFrame:
    """Rows of one day folder of a table written with ``partitionBy``; other folders are pruned."""
    return spark.read.parquet(path).where(F.col(column) == F.lit(day))
