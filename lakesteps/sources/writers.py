"""Writers and the high-water mark."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from lakesteps.sources.readers import path_exists


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to a Parquet table, creating it if needed."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Put ``df`` in the place of a Parquet table, which ``df`` itself may read.

    The new table is written beside the old one and moved in only when it is complete. Between
    the two moves the path does not exist for a moment; a move that fails puts the old table back.
    """
    spark = df.sparkSession
    incoming = f"{path.rstrip('/')}.incoming-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(incoming)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    target, source = path_of(path), path_of(incoming)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target):
        retired = path_of(f"{path.rstrip('/')}.retired-{uuid.uuid4().hex}")
        _move(fs, target, retired)
        try:
            _move(fs, source, target)
        except Exception:
            _move(fs, retired, target)
            raise
        fs.delete(retired, True)
    else:
        _move(fs, source, target)


def _move(fs, source, target) -> None:
    """Rename; some stores say no by returning false."""
    if not fs.rename(source, target):
        raise OSError(f"could not move {source.toString()} to {target.toString()}")


def write_sorted(df: DataFrame, path: str, *cols: str) -> None:
    """A table in global order, written by all tasks at once."""
    df.repartitionByRange(*cols).sortWithinPartitions(*cols).write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """CSV files with a header each. Spark writes no byte-order mark."""
    (df.write.mode("overwrite").option("header", True).option("sep", sep)
     .option("quote", '"').option("escape", '"').csv(path))


def save_mark(mark: DataFrame, path: str) -> None:
    """Store a one-row mark. Call it only after the data it stands for is saved.

    Marks are added, not overwritten, so a run that dies here still leaves the former one. A
    mark without rows (nothing new) leaves things as they are; several rows are an error.
    """
    found = mark.take(2)
    if len(found) > 1:
        raise ValueError("a mark has one row")
    if found:
        stored = mark.sparkSession.createDataFrame(found, mark.schema)
        stored.withColumn("_saved_at", F.current_timestamp()).coalesce(1).write.mode("append").json(path)


def load_mark(spark: SparkSession, path: str, schema: str) -> Row | None:
    """The latest mark, or None. ``schema`` is the DDL of the mark's columns."""
    if not path_exists(spark, path):
        return None
    marks = spark.read.schema(f"{schema}, _saved_at timestamp").json(path)
    return marks.orderBy(F.col("_saved_at").desc()).drop("_saved_at").first()
