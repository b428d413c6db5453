"""Streaming forms of the incremental loads.

Each job runs with ``availableNow``: it takes what has arrived since its checkpoint and stops, so
a schedule may start it as often as it likes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from lakesteps.operators.dedup import keep_last
from lakesteps.sources.readers import path_exists


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv", **options
) -> DataFrame:
    """Files of a folder as they arrive."""
    reader = spark.readStream.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False).option("multiLine", True)
    return reader.options(**options).format(fmt).load(path)


def with_event_time(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermark on ``ts``, which needs an instant: a timestamp without zone is read as UTC, whatever
    the session zone is."""
    if dict(stream.dtypes)[ts] != "timestamp":
        seconds = F.unix_date(F.to_date(ts)).cast("bigint") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
        stream = stream.withColumn(
            ts, F.timestamp_seconds(seconds + F.extract(F.lit("SECOND"), F.col(ts))))
    return stream.withWatermark(ts, delay)


def _writer(df: DataFrame, out: str, checkpoint: str, mode: str = "append"):
    return (
        df.writeStream.format("parquet").outputMode(mode).option("path", out)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True)
    )


def stream_append(
    spark: SparkSession, path: str, schema: T.StructType, out: str, checkpoint: str,
    fmt: str = "csv",
) -> StreamingQuery:
    """Add every file that appears in ``path`` to a table, each exactly once.

    Duplicate rows stay; readers apply ``keep_one`` to the table.
    """
    return _writer(read_stream(spark, path, schema, fmt), out, checkpoint).start()


def latest_per_batch(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """The row with the latest ``ts`` per key of each Arrow batch, before any shuffle.

    A streaming deduplication has no map-side step of its own: all rows of a key travel to the task
    that holds its state. This leaves at most one row per key and batch to travel, however much of
    the stream one key fills. The latest row stays (of equal ones the first, rows without a time
    last), because an earlier one may be too late for the watermark while the key is not.
    """
    names = list(keys)

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            times = pa.table({"ts": batch.column(ts)})
            order = pc.sort_indices(times, [("ts", "descending")], null_placement="at_end")
            places = pa.table({n: batch.column(n).take(order) for n in names} | {
                "_place": pa.array(range(batch.num_rows), pa.int64())})
            first = places.group_by(names).aggregate([("_place", "min")])["_place_min"]
            yield batch.take(order.take(first.combine_chunks()).sort())

    return df.mapInArrow(thin, df.schema)


def stream_dedup(stream: DataFrame, ts: str, delay: str, keys: Sequence[str]) -> DataFrame:
    """One row of each key within the delay. The state expires with the watermark."""
    thinned = latest_per_batch(stream, keys, ts)
    return with_event_time(thinned, ts, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_daily_counts(stream: DataFrame, ts: str, cls: str, delay: str) -> DataFrame:
    """Rows per UTC day and class in one-day windows."""
    windowed = with_event_time(stream, ts, delay).groupBy(F.window(ts, "1 day"), cls)
    day = F.date_from_unix_date(F.floor(F.unix_seconds("window.start") / 86400).cast("int"))
    return windowed.agg(F.count(F.lit(1)).alias("n")).select(day.alias("day"), cls, "n")


def write_stream(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    return _writer(df, out, checkpoint).start()


def merge_batch(
    out: str, date: str, keys: Sequence[str], ordinal: Sequence[str], staging: str
) -> Callable[[DataFrame, int], None]:
    """Upsert of one batch into a table partitioned by ``date``.

    Within the batch the last row in ``ordinal`` stays; it replaces the stored row of its key, as a
    correction may be smaller in ``ordinal``. Rows of any age take part, those without a date in a
    folder of their own. Only the day folders the batch touches are read and written again. The
    merged days are first staged under the batch number: a batch that is repeated after a failure
    finds its staged result and writes that, whatever state the table was left in. The stage of the
    batch before is then deleted.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stage = lambda n: f"{staging.rstrip('/')}/batch-{n}"
        if not path_exists(spark, f"{stage(batch_id)}/_SUCCESS"):
            batch.persist()
            merged = _merged(spark, batch, out, date, keys, ordinal)
            merged.write.mode("overwrite").parquet(stage(batch_id))
            batch.unpersist()
        rows = spark.read.schema(batch.schema).parquet(stage(batch_id))
        if not rows.isEmpty():
            # rebalance groups a day's rows into files but splits a day that holds very many
            (rows.hint("rebalance", F.col(date)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(date).parquet(out))
        before = spark._jvm.org.apache.hadoop.fs.Path(stage(batch_id - 1))
        before.getFileSystem(spark._jsc.hadoopConfiguration()).delete(before, True)

    return merge


def _merged(spark, batch, out, date, keys, ordinal) -> DataFrame:
    if not path_exists(spark, out):
        return keep_last(batch, keys, ordinal)
    # one value per calendar day: a literal list prunes the stored folders for certain
    touched = [r[0] for r in batch.select(date).distinct().collect()]
    stored = spark.read.schema(batch.schema).parquet(out)
    hit = F.col(date).isin([d for d in touched if d is not None])
    affected = stored.where(hit | F.col(date).isNull() if None in touched else hit).select(*batch.columns)
    rows = affected.withColumn("_age", F.lit(0)).unionByName(batch.withColumn("_age", F.lit(1)))
    return keep_last(rows, keys, ["_age", *ordinal]).drop("_age")


def stream_merge(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    date: str,
    keys: Sequence[str],
    ordinal: Sequence[str],
    output_mode: str = "append",
) -> StreamingQuery:
    """Late and corrected rows replace stored ones by key; of one batch's rows the last in
    ``ordinal`` wins. What is staged lies in the checkpoint folder and goes with it.

    With ``output_mode="update"`` a streaming aggregate keeps its table current, the day in
    progress included.
    """
    merge = merge_batch(out, date, keys, ordinal, f"{checkpoint.rstrip('/')}/staged")
    return (
        stream.writeStream.foreachBatch(merge).outputMode(output_mode)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
