"""Silver relations: typed, defaulted, one row per key. All are lazy."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakesteps import functions as L
from lakesteps.operators.dedup import keep_one
from lakesteps.operators.select import require, with_processed_at


def _down(*cols: str):
    return [F.col(c).desc_nulls_last() for c in cols]


def silver_flight(bronze: DataFrame) -> DataFrame:
    """One row per day: the one with the highest stated total; the total itself is recomputed."""
    rows = keep_one(
        require(bronze, ["flight_date"]),
        ["flight_date"],
        _down("total_flights", "domestic_flights", "international_flights", "data_source"),
    )
    domestic = L.to_long(F.col("domestic_flights"))
    international = L.to_long(F.col("international_flights"))
    return with_processed_at(rows.select(
        L.surrogate_key([F.col("flight_date")]).alias("flight_id"),
        F.to_date("flight_date").alias("flight_date"),
        L.default(domestic, 0).alias("domestic_flights"),
        L.default(international, 0).alias("international_flights"),
        L.total(domestic, international).alias("total_flights"),
        F.col("data_source").cast("string").alias("data_source"),
    ))


def silver_weather(bronze: DataFrame) -> DataFrame:
    """One row per day: the version with the highest mean temperature."""
    rows = keep_one(
        require(bronze, ["date"]),
        ["date"],
        _down("temp_mean", "temp_max", "temp_min", "rainfall_mm", "wind_speed_max", "source"),
    )
    return with_processed_at(rows.select(
        L.surrogate_key([F.col("date")]).alias("weather_id"),
        F.to_date("date").alias("weather_date"),
        L.fallback_mean(*[F.col(c).cast("double") for c in ("temp_mean", "temp_max", "temp_min")])
        .alias("temp_mean_celsius"),
        L.default(F.col("rainfall_mm").cast("double"), 0.0).alias("rainfall_mm"),
        L.default(F.col("wind_speed_max").cast("double"), 0.0).alias("wind_speed_max"),
    ))


GUESTS = (
    "accommodation_guests", "accommodation_intl_guests", "accommodation_domestic_guests",
)
REVENUE = "tourism_revenue_billion_vnd"


def silver_statistics(bronze: DataFrame) -> DataFrame:
    """One row per period: the one with the most guests. Annual rows have no month, so no key."""
    rows = keep_one(
        require(bronze, ["year"]), ["year", "month", "period_type"], _down(*GUESTS, REVENUE)
    )
    period = [F.col(c) for c in ("year", "month", "period_type")]
    return with_processed_at(rows.select(
        L.joined_key(period, "-").alias("stat_id"),
        L.to_long(F.col("year")).alias("stat_year"),
        L.to_long(F.col("month")).alias("stat_month"),
        F.col("period_type").cast("string").alias("period_type"),
        *[L.default(L.to_long(F.col(c)), 0).alias(c) for c in GUESTS],
        L.default(F.col(REVENUE).cast("double"), 0.0).alias(REVENUE),
    ))


def silver_news(bronze: DataFrame) -> DataFrame:
    """One row per stripped link: the latest crawl. Unscored articles are ``Uncategorized``."""
    url = L.trim_ws(F.col("url"))
    rows = keep_one(
        require(bronze, ["article_id", "title", "publish_date"]),
        [url],
        _down("crawl_time", "publish_date", "article_id", "title", "summary", "source",
              "source_system", "sentiment_score", "sentiment_label", "url"),
    )
    title, summary = L.trim_ws(F.col("title")), L.trim_ws(F.col("summary"))
    return rows.select(
        L.trim_ws(F.col("article_id")).alias("article_id"),
        F.to_date("publish_date").alias("report_date"),
        title.alias("title"),
        summary.alias("summary"),
        url.alias("url"),
        L.normal(F.col("source")).alias("source"),
        L.normal(F.col("source_system")).alias("source_system"),
        "crawl_time",
        F.length(title).cast("bigint").alias("title_length"),
        F.length(summary).cast("bigint").alias("summary_length"),
        L.default(F.col("sentiment_score"), 0).cast("bigint").alias("sentiment_score"),
        L.default(L.trim_ws(F.col("sentiment_label")), "Uncategorized").alias("sentiment_label"),
    )


def silver_trend(bronze: DataFrame) -> DataFrame:
    """Typed and normalised, not deduplicated; the key is made from the keyword as delivered."""
    day = F.col("search_date")
    return require(bronze, ["keyword", "search_interest"]).select(
        L.surrogate_key([day, F.col("keyword")], "_").alias("trend_id"),
        day.alias("report_date"),
        L.normal(F.col("keyword")).alias("keyword"),
        L.to_long(F.col("search_interest")).alias("search_interest"),
        L.normal(F.col("source")).alias("source"),
        L.normal(F.col("source_system")).alias("source_system"),
        "crawl_time",
        F.year(day).cast("bigint").alias("year"),
        F.month(day).cast("bigint").alias("month"),
        L.year_month(day).alias("year_month"),
    )


def silver_events(bronze: DataFrame) -> DataFrame:
    """Dates given as month, quarter or year become the first day of it, at both ends."""
    rows = require(bronze, ["event_name", "start_date", "end_date"]).select(
        L.trim_ws(F.col("event_name")).alias("event_name"),
        L.parse_partial_date(F.col("start_date")).alias("start_date"),
        L.parse_partial_date(F.col("end_date")).alias("end_date"),
        L.trim_ws(F.col("location")).alias("location"),
        F.initcap(L.trim_ws(F.col("category"))).alias("category"),
    )
    start, end = F.col("start_date"), F.col("end_date")
    return rows.select(
        L.surrogate_key([start, F.col("event_name")], "_").alias("event_id"),
        "event_name", "start_date", "end_date", "location", "category",
        L.duration_days(start, end).cast("bigint").alias("duration_days"),
        F.year(start).cast("bigint").alias("event_year"),
    )
