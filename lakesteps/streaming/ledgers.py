"""Streams that remember: keys seen ever, and days that late rows correct.

Both keep what they know in tables beside the result, one folder per batch, so that nothing expires
and the state of a key or day does not live in an executor. A batch is named after its stream's
checkpoint and its number. What a batch has written is left out when the batch is repeated after a
failure, and written again, so each batch counts once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from lakesteps.operators.dedup import keep_first
from lakesteps.sources.readers import path_exists

#: Folders that the digests of seen keys are dealt to; a batch reads those of its own keys.
BUCKETS = 256
#: Batches whose digests lie in folders of their own before they are put together.
KEEP_BATCHES = 20

SEEN = "digest binary, bucket int, batch string"


def _path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path: str) -> list[str]:
    place, fs = _path(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(place)) if fs.exists(place) else []


def _delete(spark: SparkSession, path: str) -> None:
    place, fs = _path(spark, path)
    fs.delete(place, True)


def batch_name(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """A name that no batch of another stream has, also one that starts anew in the same folder."""
    first = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()
    return f"{json.loads(first[0])['id']}-{batch_id:09d}"


def _run(stream: DataFrame, work: Callable[[DataFrame, str], None], checkpoint: str) -> StreamingQuery:
    def batch(rows: DataFrame, batch_id: int) -> None:
        work(rows, batch_name(rows.sparkSession, checkpoint, batch_id))

    return (stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


# ---- keys seen ever

def key_digest(df: DataFrame, keys: Sequence[str]) -> Column:
    """32 bytes that differ wherever the keys do; null and empty are told apart."""
    part = lambda k: F.coalesce(
        F.concat(F.octet_length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string")), F.lit("-"))
    return F.unhex(F.sha2(F.concat(F.lit(""), *[part(k) for k in keys]), 256))


def first_seen(batch: DataFrame, name: str, root: str, keys: Sequence[str], order: Sequence[str],
               buckets: int = BUCKETS, keep: int = KEEP_BATCHES) -> None:
    """Add to ``root/rows`` the rows of ``batch`` whose key no earlier batch had.

    Of a batch's rows with one key the first in ``order`` counts, which must leave no ties. Rows of
    any age take part and nothing is forgotten. ``root/seen`` holds a digest per key in buckets; a
    batch reads the buckets of its own keys only, and of these no more than digests. The key thins
    to one row per task before it is shuffled, so a hot key costs a row per task.
    """
    spark = batch.sparkSession
    seen, rows = f"{root.rstrip('/')}/seen", f"{root.rstrip('/')}/rows"
    _compact(spark, seen, name, buckets, keep)
    digest = key_digest(batch, keys)
    firsts = keep_first(batch, keys, order).withColumn("_digest", digest).withColumn(
        "_bucket", F.pmod(F.xxhash64("_digest"), F.lit(buckets)).cast("int"))
    firsts = firsts.persist()
    try:
        known = _stored(spark, seen).where(F.col("batch") != name)
        touched = [r[0] for r in firsts.select("_bucket").distinct().collect()]  # at most ``buckets``
        known = known.where(F.col("bucket").isin(touched) if len(touched) < buckets else F.lit(True))
        new = firsts.join(known.select("digest", "bucket"),
                          (F.col("_bucket") == F.col("bucket")) & (F.col("_digest") == F.col("digest")), "left_anti")
        # rows first: digests without their rows would lose them if the batch failed between the two
        new.drop("_digest", "_bucket").write.mode("overwrite").parquet(f"{rows}/batch={name}")
        # found anew from the same stored digests, as those of this batch are left out
        (new.select(F.col("_digest").alias("digest"), F.col("_bucket").alias("bucket"))
         .hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{seen}/batch={name}"))
    finally:
        firsts.unpersist()


def _stored(spark: SparkSession, seen: str) -> DataFrame:
    if not _children(spark, seen):
        return spark.createDataFrame([], SEEN)
    return spark.read.schema(SEEN).parquet(seen)


def _compact(spark: SparkSession, seen: str, name: str, buckets: int, keep: int) -> None:
    """Put the folders of finished batches together once there are more than ``keep``.

    Digests are a set, so it does no harm if a failure leaves them in the old folders and the new.
    The batch in hand is left out: its digests must not count as seen if it is repeated.
    """
    old = [f for f in _children(spark, seen) if f.startswith("batch=") and f != f"batch={name}"]
    if len(old) <= keep:
        return
    together = spark.read.schema(SEEN).parquet(seen).where(F.col("batch").isin([f[6:] for f in old]))
    (together.select("digest", "bucket").hint("rebalance", "bucket").write.mode("overwrite")
     .partitionBy("bucket").parquet(f"{seen}/batch=all-{uuid.uuid4().hex}"))
    for folder in old:
        _delete(spark, f"{seen}/{folder}")


def stream_first_seen(stream: DataFrame, root: str, checkpoint: str, keys: Sequence[str], order: Sequence[str],
                      **how) -> StreamingQuery:
    """The first row of each key over the whole life of the stream, into ``root/rows``."""
    return _run(stream, lambda rows, name: first_seen(rows, name, root, keys, order, **how), checkpoint)


def read_first_seen(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/rows").select(*(f"`{c}`" for c in schema.names))


# ---- days that late rows correct

DELTA = "cls string, n long, n_late long"


def count_days(batch: DataFrame, name: str, root: str, ts: str, cls: str, delay: str) -> None:
    """Take one batch into the daily counts below ``root``.

    A row is late if its day was settled when its batch began, that is, the day ends no later than
    the latest time of all earlier batches less ``delay``. Late rows are kept as they are in
    ``late``; timely and late rows both become counts per day and class in ``deltas``. The days
    settled by this batch's own times, and settled days with late rows, are then written anew in
    ``settled`` from their deltas, the late ones as a correction; other days are not touched. Rows
    without a time have no day and are kept in ``late`` only.
    """
    spark, root = batch.sparkSession, root.rstrip("/")
    marks = spark.read.schema("latest timestamp, batch string").parquet(f"{root}/marks") if _children(spark, f"{root}/marks") \
        else spark.createDataFrame([], "latest timestamp, batch string")
    back = F.expr(f"INTERVAL {delay}")
    before = marks.where(F.col("batch") != name).agg(F.max("latest")).first()[0]
    day = F.to_date(ts)
    ends = F.date_add(day, 1).cast("timestamp")
    mark = F.lit(before).cast("timestamp") - back
    late = F.coalesce(ends <= mark, F.lit(False)) | F.col(ts).isNull()
    batch.where(late).write.mode("overwrite").parquet(f"{root}/late/batch={name}")
    counts = batch.where(F.col(ts).isNotNull()).groupBy(day.alias("day"), F.col(cls).cast("string").alias("cls")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(late).alias("n_late"))
    # no day has two folders of one batch, as a batch that is repeated replaces its own
    counts.write.mode("overwrite").partitionBy("day").parquet(f"{root}/deltas/batch={name}")
    (batch.agg(F.max(ts).cast("timestamp").alias("latest")).coalesce(1)
     .write.mode("overwrite").parquet(f"{root}/marks/batch={name}"))
    _settle(spark, root, name, before, delay)


def _deltas(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(f"{DELTA}, batch string, day date").parquet(f"{root}/deltas")


def _settle(spark: SparkSession, root: str, name: str, before, delay: str) -> None:
    marks = spark.read.schema("latest timestamp, batch string").parquet(f"{root}/marks")
    ends = F.date_add("day", 1).cast("timestamp")
    back = F.expr(f"INTERVAL {delay}")
    now = marks.agg(F.max("latest")).first()[0]
    if now is None:
        return
    deltas, settled = _deltas(spark, root), ends <= F.lit(now) - back
    newly = settled if before is None else settled & (ends > F.lit(before) - back)
    # a batch that is repeated settles the same days again, with the same result
    fresh = deltas.where(newly).select("day").distinct()
    corrected = deltas.where((F.col("batch") == name) & settled).select("day").distinct()
    days = [r[0] for r in fresh.union(corrected).distinct().collect()]  # one value per calendar day
    if not days:
        return
    sums = deltas.where(F.col("day").isin(days)).groupBy("day", "cls").agg(
        F.sum("n").alias("n"), F.sum("n_late").alias("n_late"))
    (sums.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day")
     .parquet(f"{root}/settled"))


def stream_corrected_days(stream: DataFrame, root: str, checkpoint: str, ts: str, cls: str, delay: str) -> StreamingQuery:
    """Rows per UTC day and class, where late rows correct the days they belong to."""
    return _run(stream, lambda rows, name: count_days(rows, name, root, ts, cls, delay), checkpoint)


def read_corrected_days(spark: SparkSession, root: str, open_days: bool = True) -> DataFrame:
    """day, cls, n, n_late (of n, how many came late): settled days, and those still open unless
    ``open_days`` is off."""
    root, schema = root.rstrip("/"), f"{DELTA}, day date"
    done = spark.read.schema(schema).parquet(f"{root}/settled") if path_exists(spark, f"{root}/settled") \
        else spark.createDataFrame([], schema)
    done = done.select("day", "cls", "n", "n_late")
    if not open_days:
        return done
    rest = _deltas(spark, root).join(done.select(F.col("day").alias("d")).distinct(), F.col("day") == F.col("d"), "left_anti")
    return done.unionByName(rest.groupBy("day", "cls").agg(F.sum("n").alias("n"), F.sum("n_late").alias("n_late")))


def read_late(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The late rows themselves, with the ``batch`` they came in."""
    return spark.read.schema(T.StructType([*schema, T.StructField("batch", T.StringType())])).parquet(f"{root.rstrip('/')}/late")
