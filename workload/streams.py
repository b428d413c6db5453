"""Streaming jobs over the event table, run to the end of the available files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lakesteps.operators import keep_last
from lakesteps.session import run_dir
from lakesteps.streaming import (
    read_corrected_days, read_first_seen, read_late, read_stream, stream_append, stream_corrected_days,
    stream_daily_counts, stream_dedup, stream_first_seen, stream_merge, write_stream,
)
from workload.registry import query


def _arrivals(t):
    """Where the event files lie, their schema, and a place for the job's output.

    The pattern also takes a table that is one file, which a stream would not read by its name.
    """
    root = f"{run_dir(t.spark)}/stream-{uuid.uuid4().hex}"
    return f"{t.sf_dir}/event[s].parquet", t("events").schema, root


def _finish(job):
    job.awaitTermination()


@query("stream_append", "SELECT event_id, user_id, event_type, value FROM events")
def stream_append_events(t):
    path, schema, root = _arrivals(t)
    for _ in range(2):  # the second run finds nothing new
        _finish(stream_append(t.spark, path, schema, f"{root}/out", f"{root}/cp", "parquet"))
    rows = t.spark.read.schema(schema).parquet(f"{root}/out")
    return rows.select("event_id", "user_id", "event_type", "value")


@query("stream_append_dedup", """
SELECT event_id, user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def stream_append_dedup(t):
    path, schema, root = _arrivals(t)
    _finish(stream_append(t.spark, path, schema, f"{root}/out", f"{root}/cp", "parquet"))
    rows = t.spark.read.schema(schema).parquet(f"{root}/out")
    kept = keep_last(rows, ["user_id", "event_type"], ["ts", "event_id"])
    return kept.select("event_id", "user_id", "event_type", "value")


@query("stream_dedup", "SELECT DISTINCT user_id FROM events")
def stream_dedup_users(t):
    path, schema, root = _arrivals(t)
    stream = read_stream(t.spark, path, schema, "parquet").select("ts", "user_id")
    rows = stream_dedup(stream, "ts", "60 days", ["user_id"])
    _finish(write_stream(rows.select("user_id"), f"{root}/out", f"{root}/cp"))
    return t.spark.read.schema("user_id bigint").parquet(f"{root}/out")


@query("stream_daily", """
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def stream_daily(t):
    path, schema, root = _arrivals(t)
    stream = read_stream(t.spark, path, schema, "parquet")
    counts = stream_daily_counts(stream, "ts", "event_type", "40 days")
    _finish(stream_merge(counts, f"{root}/out", f"{root}/cp", "day", ["day", "event_type"], ["n"],
                         output_mode="update"))
    return t.spark.read.schema("day date, event_type string, n bigint").parquet(f"{root}/out")


@query("stream_merge", """
SELECT CAST(ts AS DATE) AS day, user_id, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id DESC) = 1""")
def stream_merge_users(t):
    path, schema, root = _arrivals(t)
    stream = read_stream(t.spark, path, schema, "parquet").select(
        F.to_date("ts").alias("day"), "user_id", "event_id", "value")
    _finish(stream_merge(stream, f"{root}/out", f"{root}/cp", "day", ["day", "user_id"], ["event_id"]))
    return t.spark.read.schema("day date, user_id bigint, event_id bigint, value double").parquet(
        f"{root}/out")


# Three arrivals, one batch each: later ones correct values, some rows have no date and some lie
# beyond 2038. The last arrival of a key counts, and in it the largest event.
@query("stream_merge_batches", """
WITH a AS (SELECT CASE WHEN user_id % 50 = 0 THEN NULL WHEN user_id % 7 = 0
      THEN CAST(CAST(ts AS DATE) + INTERVAL 20 YEAR AS DATE) ELSE CAST(ts AS DATE) END AS day,
    user_id, event_id % 3 AS part, 1000000 - event_id AS event_id, value + event_id % 3 AS value FROM events)
SELECT day, user_id, event_id, value FROM a
QUALIFY row_number() OVER (PARTITION BY day, user_id ORDER BY part DESC, event_id DESC) = 1""")
def stream_merge_batches(t):
    _, _, root = _arrivals(t)
    user, date = F.col("user_id"), F.to_date("ts")
    day = F.when(user % 50 == 0, None).when(user % 7 == 0, F.add_months(date, 240)).otherwise(date)
    rows = t("events").select(
        day.alias("day"), "user_id", (F.col("event_id") % 3).alias("part"),
        (1000000 - F.col("event_id")).alias("event_id"), (F.col("value") + F.col("event_id") % 3).alias("value"))
    schema = rows.drop("part").schema
    for part in range(3):  # arrivals are taken in the order in which they were written
        rows.where(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = read_stream(t.spark, f"{root}/in", schema, "parquet", maxFilesPerTrigger=1)
        _finish(stream_merge(stream, f"{root}/out", f"{root}/cp", "day", ["day", "user_id"], ["event_id"]))
    return t.spark.read.schema(schema).parquet(f"{root}/out")


# Keys seen again late and early, in several batches, with times beyond 2038.
@query("stream_dedup_batches", "SELECT DISTINCT user_id FROM events")
def stream_dedup_batches(t):
    _, _, root = _arrivals(t)
    rows = t("events").select(
        F.when(F.col("user_id") % 7 == 0, F.col("ts") + F.expr("interval 20 years")).otherwise(F.col("ts")).alias("ts"),
        "user_id")
    for part in range(3):
        rows.where(F.col("user_id") % 3 == part).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = read_stream(t.spark, f"{root}/in", rows.schema, "parquet", maxFilesPerTrigger=1)
    kept = stream_dedup(stream, "ts", "30 years", ["user_id"])
    _finish(write_stream(kept.select("user_id"), f"{root}/out", f"{root}/cp"))
    return t.spark.read.schema("user_id bigint").parquet(f"{root}/out")


def _in_three(rows, root, schema):
    """The stream of each of three arrivals in turn, a third of the events each by ``part``."""
    for part in range(3):
        rows.where(F.col("part") == part).drop("part").write.mode("append").parquet(f"{root}/in")
        yield read_stream(rows.sparkSession, f"{root}/in", schema, "parquet")


# Users come again in every arrival, at times before and after those of the arrivals before.
@query("stream_seen_ever", """
SELECT event_id, user_id, event_type, value, event_id % 3 AS part FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id % 3, ts, event_id) = 1""")
def stream_seen_ever(t):
    _, _, root = _arrivals(t)
    rows = t("events").withColumn("part", F.col("event_id") % 3)
    for stream in _in_three(rows, root, t("events").schema):
        _finish(stream_first_seen(stream, root, f"{root}/cp", ["user_id", "event_type"], ["ts", "event_id"], keep=1))
    kept = read_first_seen(t.spark, root, t("events").schema)
    return kept.select("event_id", "user_id", "event_type", "value", (F.col("event_id") % 3).alias("part"))


# A delay of two days against arrivals that each span the whole time: most rows of the later two are late.
@query("stream_days_corrected", """
WITH a AS (SELECT event_id, CAST(ts AS DATE) AS day, ts, event_type AS cls, event_id % 3 AS part FROM events),
m AS (SELECT p AS part, max(ts) - INTERVAL 2 DAY AS mark FROM a JOIN (SELECT unnest([1, 2]) AS p) ON a.part < p GROUP BY p)
SELECT day, cls, count(*) AS n, count(*) FILTER (CAST(day + INTERVAL 1 DAY AS TIMESTAMP) <= mark) AS n_late
FROM a LEFT JOIN m USING (part) GROUP BY day, cls""")
def stream_days_corrected(t):
    _, _, root = _arrivals(t)
    rows = t("events").withColumn("part", F.col("event_id") % 3)
    for stream in _in_three(rows, root, t("events").schema):
        _finish(stream_corrected_days(stream, root, f"{root}/cp", "ts", "event_type", "2 DAYS"))
    return read_corrected_days(t.spark, root)


@query("stream_late_rows", """
WITH m AS (SELECT p AS part, max(ts) - INTERVAL 2 DAY AS mark
           FROM events JOIN (SELECT unnest([1, 2]) AS p) ON event_id % 3 < p GROUP BY p)
SELECT event_id, user_id FROM events JOIN m ON part = event_id % 3
WHERE CAST(CAST(ts AS DATE) + INTERVAL 1 DAY AS TIMESTAMP) <= mark""")
def stream_late_rows(t):
    _, _, root = _arrivals(t)
    rows = t("events").withColumn("part", F.col("event_id") % 3)
    for stream in _in_three(rows, root, t("events").schema):
        _finish(stream_corrected_days(stream, root, f"{root}/cp", "ts", "event_type", "2 DAYS"))
    return read_late(t.spark, root, t("events").schema).select("event_id", "user_id")
