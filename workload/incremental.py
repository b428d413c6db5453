"""Deduplication and incremental merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakesteps import functions as L
from lakesteps.operators import (
    backfill, high_water, keep_first, keep_last, keep_one, merge_new_first, new_or_changed, newest,
    overwrite_window, priority_union, require, take_until_marker,
)
from workload.registry import query, trim


@query("dedup_latest_order", """
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice
FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def dedup_latest_order(t):
    rows = require(t("orders"), ["o_custkey", "o_orderdate"]).select(
        "o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("order_date"), "o_totalprice")
    return keep_one(rows, ["o_custkey"], [F.desc("order_date"), F.desc("o_orderkey")])


@query("dedup_trim_expr", f"""
SELECT {trim("split_part(url, '/', 3)")} AS host, page_id, url FROM pages
QUALIFY row_number() OVER (PARTITION BY {trim("split_part(url, '/', 3)")} ORDER BY page_id DESC) = 1""")
def dedup_trim_expr(t):
    host = L.trim_ws(F.split_part("url", F.lit("/"), F.lit(3)))
    rows = keep_one(t("pages").select("page_id", "url"), [host], [F.desc("page_id")])
    return rows.select(host.alias("host"), "page_id", "url")


def _feed(t):
    return t("events").select("event_id", F.to_date("ts").alias("day"), "ts", "user_id",
                              "event_type", "value")


FEED_COLS = "event_id, CAST(ts AS DATE) AS day, user_id, event_type, value"


@query("keep_first_feed", f"""
SELECT {FEED_COLS} FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""")
def keep_first_feed(t):
    return keep_first(_feed(t), ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("keep_last_feed", f"""
SELECT {FEED_COLS} FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def keep_last_feed(t):
    return keep_last(_feed(t), ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("priority_union", f"""
SELECT {FEED_COLS}, origin FROM (
  SELECT *, 'archive' AS origin, 0 AS p FROM events WHERE ts < '2024-01-28'
  UNION ALL SELECT *, 'live', 1 FROM events WHERE ts >= '2024-01-26')
QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
  ORDER BY p DESC, ts DESC, event_id DESC) = 1""")
def priority_union_days(t):
    archive = _feed(t).where("ts < timestamp_ntz'2024-01-28'").withColumn("origin", F.lit("archive"))
    live = _feed(t).where("ts >= timestamp_ntz'2024-01-26'").withColumn("origin", F.lit("live"))
    return priority_union([archive, live], ["user_id", "day"], ["ts", "event_id"]).drop("ts")


@query("backfill_days", """
SELECT day, max_by(event_id, (p, ts, event_id)) AS event_id, max_by(origin, (p, ts, event_id)) AS origin
FROM (SELECT CAST(ts AS DATE) AS day, ts, event_id, 'archive' AS origin, 0 AS p FROM events
      WHERE CAST(ts AS DATE) <= (SELECT max(CAST(ts AS DATE)) - 3 FROM events)
      UNION ALL SELECT CAST(ts AS DATE), ts, event_id, 'live', 1 FROM events
      WHERE CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) - 2 FROM events))
GROUP BY day""")
def backfill_days(t):
    rows = _feed(t).select("day", "ts", "event_id")
    return backfill(
        rows.withColumn("origin", F.lit("archive")), rows.withColumn("origin", F.lit("live")),
        "day", high_water(rows, "day"), ordinal=["ts", "event_id"],
    ).drop("ts")


@query("merge_new_first", """
SELECT o_orderkey, title, CASE WHEN bad THEN NULL ELSE d END AS order_date, origin
FROM (SELECT * FROM (
  SELECT o_orderkey, o_orderpriority AS title, CAST(o_orderdate AS DATE) AS d, 'old' AS origin,
    1 AS age, false AS bad FROM orders WHERE o_orderdate < '1999-01-01'
  UNION ALL SELECT o_orderkey, nullif(o_orderpriority, '5-LOW'), CAST(o_orderdate AS DATE), 'new',
    0, o_orderstatus = 'P' FROM orders WHERE o_orderdate >= '1997-01-01')
  QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY age) = 1)
WHERE title IS NOT NULL""")
def merge_new_first_orders(t):
    orders = t("orders")
    iso, other = [F.date_format("o_orderdate", p) for p in ("yyyy-MM-dd", "dd/MM/yyyy")]
    old = orders.where("o_orderdate < timestamp_ntz'1999-01-01'").select(
        "o_orderkey", F.col("o_orderpriority").alias("title"), iso.alias("order_date"),
        F.lit("old").alias("origin"))
    new = orders.where("o_orderdate >= timestamp_ntz'1997-01-01'").select(
        "o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("title"),
        F.when(F.col("o_orderstatus") == "P", other).otherwise(iso).alias("order_date"),
        F.lit("new").alias("origin"))
    return merge_new_first(old, new, "o_orderkey", "order_date", drop_blank_title=True)


@query("overwrite_window", """
WITH days AS (
  SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n_all,
    count(*) FILTER (value >= 20) AS n_new FROM events GROUP BY 1, 2),
start AS (SELECT max(day) - 9 AS s FROM days)
SELECT day, event_type, n_all AS n FROM days, start WHERE day < s
UNION ALL SELECT day, event_type, n_new FROM days, start WHERE day >= s AND n_new > 0""")
def overwrite_window_days(t):
    events = t("events").select(F.to_date("ts").alias("day"), "event_type", "value")

    def daily(rows):
        return rows.groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n"))

    old = daily(events)
    start = F.date_sub(high_water(events, "day"), 9)
    new = daily(events.where("value >= 20")).where(F.col("day") >= start)
    return overwrite_window(old, new, "day", start, ["day", "event_type"])


@query("new_or_changed", """
SELECT o_orderkey, o_totalprice, o_orderpriority, CAST(o_orderdate AS TIMESTAMP) AS seen FROM orders
WHERE o_orderdate >= '1999-01-01' OR o_orderstatus = 'P' OR o_orderkey % 7 = 0""")
def new_or_changed_orders(t):
    cols = ["o_orderkey", "o_totalprice", "o_orderpriority", "seen"]
    orders = t("orders").withColumn("seen", F.col("o_orderdate").cast("timestamp_ntz"))
    # the stored copy ends in 1998, its rows in state P had another price, and every seventh
    # was seen a microsecond earlier
    price = F.when(F.col("o_orderstatus") == "P", -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    old = orders.where("o_orderdate < timestamp_ntz'1999-01-01'").withColumn("o_totalprice", price)
    old = old.withColumn("seen", F.when(
        F.col("o_orderkey") % 7 == 0, F.col("seen") - F.expr("interval 0.000001 second")).otherwise(F.col("seen")))
    return new_or_changed(old.select(*cols), orders.select(*cols), ["o_orderkey"])


# The marker is the event of the highest value: one row that goes to the driver, as a stored mark would.
@query("take_until_marker", f"""
SELECT {FEED_COLS} FROM events WHERE (ts, event_id) > (
  SELECT max((ts, event_id)) FROM events WHERE event_id = (SELECT max_by(event_id, (value, event_id)) FROM events))""")
def take_until_marker_events(t):
    marker = t("events").agg(F.max_by("event_id", F.struct("value", "event_id"))).first()[0]
    return take_until_marker(_feed(t), ["ts", "event_id"], "event_id", marker).drop("ts")


@query("newest_record", """
SELECT event_type, CAST(ts AS DATE) AS last_publish_date, event_id AS last_article_id
FROM events ORDER BY ts DESC, event_id DESC LIMIT 1""")
def newest_record(t):
    top = newest(t("events").select("event_id", "ts", "event_type"), ["ts", "event_id"])
    return top.select("event_type", F.to_date("ts").alias("last_publish_date"),
                      F.col("event_id").alias("last_article_id"))
