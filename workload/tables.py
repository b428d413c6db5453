"""Named tables, ordered files, typed dates and failing models: operators that leave their mark on
storage or order, with that mark as a column."""

from __future__ import annotations

import uuid

from pyspark.sql import Observation, Window, functions as F, types as T

from lakesteps.operators import newest_first, project, score_text, unique_columns
from lakesteps.operators.select import with_processed_at
from lakesteps.plans import build_gold, build_silver
from lakesteps.session import materialize, run_dir
from lakesteps.sources import Catalog, export_csv, read_typed_csv, write_sorted
from workload.cleaning import CLEANED, NEGATIVE_WORDS, POSITIVE_WORDS, SCORED_SQL
from workload.models import (
    event_feed, flight_feed, news_feed, statistics_feed, trend_feed, weather_feed,
)
from workload.registry import query, with_ctes


def _folder(t, name):
    return f"{run_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


def _placed(spark, path, schema):
    """Rows with their place in the table as it is stored: files by name, rows as written."""
    rows = spark.read.schema(schema).parquet(path).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("n"))
    # one row per file
    before = F.sum("n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1))
    offsets = files.select("_file", F.coalesce(before, F.lit(0)).alias("_before"))
    placed = rows.join(offsets, "_file")
    return placed.withColumn("place", F.col("_before") + F.col("_row") + 1).drop("_file", "_row", "_before")


@query("project_columns", "SELECT c_custkey AS id, c_name AS name, true AS stamped FROM customer")
def project_columns(t):
    twice = t("customer").select("c_custkey", "c_name", F.upper("c_name").alias("c_name"))
    rows = with_processed_at(project(unique_columns(twice), {"id": "c_custkey", "name": "c_name"}))
    return rows.select("id", "name", (F.col("dbt_processed_at") <= F.current_timestamp()).alias("stamped"))


@query("sorted_table", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS place FROM orders""")
def sorted_table(t):
    path, rows = _folder(t, "sorted"), t("orders").select("o_orderkey", "o_totalprice")
    write_sorted(rows, path, "o_totalprice", "o_orderkey")
    return _placed(t.spark, path, rows.schema).drop("o_totalprice")


@query("newest_first_order", """
SELECT event_id, row_number() OVER (ORDER BY day DESC NULLS LAST, event_id) AS place
FROM (SELECT event_id, CASE WHEN user_id % 9 > 0 THEN CAST(ts AS DATE) END AS day FROM events)""")
def newest_first_order(t):
    day = F.when(F.col("user_id") % 9 > 0, F.to_date("ts"))
    path, rows = _folder(t, "newest"), t("events").select("event_id", day.alias("day"))
    newest_first(rows, "day", "event_id").write.parquet(path)
    return _placed(t.spark, path, rows.schema).drop("day")


@query("catalog_rebuild", """
SELECT o_orderstatus AS status, count(*) + 1 AS n, 'table' AS kind FROM orders GROUP BY 1
UNION ALL SELECT o_orderstatus, count(*), 'view' FROM orders GROUP BY 1""")
def catalog_rebuild(t):
    catalog, name = Catalog(t.spark, _folder(t, "catalog")), f"t{uuid.uuid4().hex}"
    counts = t("orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    view = catalog.view(f"{name}_view", counts.withColumn("kind", F.lit("view")))
    catalog.table(name, counts)
    catalog.table(name, catalog.source(name).withColumn("n", F.col("n") + 1))  # from itself
    built = catalog.source(name).withColumn("kind", F.lit("table"))
    return built.unionByName(view)


@query("typed_dates", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderdate AS DATE) END AS day,
  CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice END AS price, NULL::VARCHAR AS absent FROM orders""")
def typed_dates(t):
    path = _folder(t, "dates")
    export_csv(t("orders").select(
        F.when(F.col("o_orderkey") % 5 > 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise("soon,\nor late").alias("day"),
        F.when(F.col("o_orderkey") % 7 > 0, F.col("o_totalprice").cast("string")).otherwise("n/a").alias("price"),
        "o_orderkey"), path)
    schema = T.StructType.fromDDL("o_orderkey bigint, day date, price double, absent string")
    return read_typed_csv(t.spark, path, schema, date_cols=["day"], strict=False)


# The model fails on texts that start with a t: those count as failed and are neutral.
FAILS = f"lower(substr(coalesce(nullif({CLEANED}, ''), 'trống'), 1, 1)) = 't'"


@query("score_failing_model", f"""
SELECT s.doc_id, CASE WHEN f.bad THEN 0 ELSE s.score END AS score,
  CASE WHEN f.bad THEN 'Trung lập' ELSE s.label END AS label, (sum(CAST(f.bad AS INT)) OVER ())::BIGINT AS failed
FROM ({SCORED_SQL}) s JOIN (SELECT doc_id, {FAILS} AS bad FROM documents) f USING (doc_id)""")
def score_failing_model(t):
    good, bad = frozenset(POSITIVE_WORDS), frozenset(NEGATIVE_WORDS)

    def load():
        def scorer(texts):
            if any(text[:1].lower() == "t" for text in texts):
                raise RuntimeError("out of memory")
            sums = [sum((w in good) - (w in bad) for w in text.lower().split()) for text in texts]
            return ["POS" if s > 0 else "NEG" if s < 0 else "NEU" for s in sums]

        return scorer

    seen = Observation()
    scored = materialize(score_text(
        t("documents").select("doc_id", "text"), "text", load, batch_size=1, observation=seen
    ).drop("text"), "scored")
    return scored.select("doc_id", F.col("score").cast("bigint").alias("score"), "label",
                         F.lit(seen.get["failed"]).cast("bigint").alias("failed"))


_TABLES = {"dim_location": 1, "dim_event": 1, "dim_news": 1, "dim_sentiment": 1, "dim_time": 1, "fact_news": 1,
           "fact_tourism": 1}
_READERS = {"mart_tourism_data_mart": None, "mart_tourism_health_index": 1, "tourism_health_index": 1,
            "scenario_simulation": 3}


@query("whole_build", with_ctes("\nUNION ALL\n".join([
    *(f"SELECT '{name}' AS relation, count(*) AS n FROM {name}" for name in _TABLES),
    *(f"SELECT '{name}', {k} * count(*) FROM fact_tourism" for name, k in _READERS.items() if k)]), *_TABLES))
def whole_build(t):
    catalog = Catalog(t.spark, _folder(t, "gold"))
    views = build_silver(catalog, {
        "flight": flight_feed(t), "weather": weather_feed(t), "tourism_stats": statistics_feed(t),
        "news": news_feed(t), "google_trends": trend_feed(t), "event": event_feed(t)})
    # the feeds hold rows that fail column tests, which would stop the build
    built = build_gold(catalog, views, event_feed(t), checked=False)
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("relation"), "n")
              for name, df in built.items() if name in _TABLES or _READERS.get(name)]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out
