"""Gold relations: dimensions, facts, marts, indexes and scenarios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakesteps import functions as L
from lakesteps.operators.keys import dense_key, lookup_dim
from lakesteps.operators.reshape import explode_months
from lakesteps.operators.rollup import (
    distinct_values, left_join_all, rollup_spec, union_distinct,
)
from lakesteps.operators.scaling import minmax_scale, scenarios
from lakesteps.operators.scoring import NEGATIVE, NEUTRAL, POSITIVE
from lakesteps.plans.silver import GUESTS, REVENUE

MONTH = ("year", "month")


def calendar_dim(dates: Sequence[DataFrame]) -> DataFrame:
    """One row per day that occurs in any of the one-column inputs."""
    named = [df.toDF("date_key") for df in dates]
    d = F.col("date_key")
    return union_distinct(named).select(
        d,
        F.year(d).cast("bigint").alias("year"),
        F.quarter(d).cast("bigint").alias("quarter"),
        F.month(d).cast("bigint").alias("month"),
        F.day(d).cast("bigint").alias("day"),
        L.week_sunday(d).cast("bigint").alias("week_of_year"),
        L.day_name(d).alias("day_of_week"),
        F.coalesce(L.is_weekend(d), F.lit(False)).alias("is_weekend"),
    )


def dim_location(events: DataFrame) -> DataFrame:
    return dense_key(distinct_values(events, "location"), ["location"], "location_key")


def dim_event(events: DataFrame, locations: DataFrame, repair_dates: bool = False) -> DataFrame:
    """Events with a dense key and their location key.

    Only full dates count unless ``repair_dates`` is set: an event dated ``2024-05`` has no start
    and comes first in the order.
    """
    parse = L.parse_partial_date if repair_dates else L.parse_date_strict
    rows = events.select(
        "event_name",
        parse(F.col("start_date")).alias("start_date"),
        parse(F.col("end_date")).alias("end_date"),
        "location",
        "category",
    )
    keyed = lookup_dim(rows, locations, ["location"], "location_key").select(
        "event_name", "start_date", "end_date", "location_key", "category"
    )
    order = ["start_date", "event_name", "end_date", "location_key", "category"]
    return dense_key(keyed, [F.col(c).asc_nulls_first() for c in order], "event_key", ties=True)


def dim_news(silver: DataFrame) -> DataFrame:
    cols = ["article_id", "report_date", "title", "summary", "url", "source", "source_system",
            "crawl_time"]
    return dense_key(
        silver.select(*cols),
        [F.col(c).asc_nulls_first() for c in ("report_date", "article_id", "url")],
        "article_key",
    )


def dim_sentiment(silver: DataFrame) -> DataFrame:
    labels = distinct_values(silver, "sentiment_label")
    return dense_key(labels, ["sentiment_label"], "sentiment_key")


def fact_news(
    silver: DataFrame,
    news: DataFrame,
    calendar: DataFrame,
    sentiments: DataFrame,
    on: Sequence[str] = ("article_id", "url"),
) -> DataFrame:
    """One row per article with the keys of its dimensions.

    The link is part of the join key because silver is unique by link only: two links that share
    an ``article_id`` would otherwise pair up with each other. With unique ids, ``on`` of
    ``article_id`` alone gives the same rows.
    """
    days = calendar.select(F.col("date_key").alias("report_date"), "date_key")
    keyed = lookup_dim(silver, news, list(on), "article_key")
    keyed = lookup_dim(keyed, days, ["report_date"], "date_key")
    keyed = lookup_dim(keyed, sentiments, ["sentiment_label"], "sentiment_key")
    return keyed.select("article_key", "date_key", "sentiment_key", "sentiment_score")


def _month_of(date: str) -> list[Column]:
    d = F.col(date)
    return [F.year(d).cast("bigint").alias("year"), F.month(d).cast("bigint").alias("month")]


def news_by_month(facts: DataFrame, sentiments: DataFrame) -> DataFrame:
    """Article counts per month and class. Classes go by label; other labels count in the total.

    The fact's ``date_key`` is the article's own date, so the articles are not read again; facts
    without an article do not count.
    """
    dated = lookup_dim(facts.where("article_key is not null"), sentiments, ["sentiment_key"], "sentiment_label")
    label = F.col("sentiment_label")
    return dated.groupBy(*_month_of("date_key")).agg(
        F.count(F.lit(1)).alias("news_count"),
        L.count_where(label == POSITIVE[2]).alias("positive_news"),
        L.count_where(label == NEUTRAL[2]).alias("neutral_news"),
        L.count_where(label == NEGATIVE[2]).alias("negative_news"),
    )


def event_days_by_month(events: DataFrame) -> DataFrame:
    """Event days per month: an event counts once for every day it lasts."""
    months = explode_months(events.where("event_key is not null"), "start_date", "end_date")
    return months.groupBy(*_month_of("month_start")).agg(F.sum("days").alias("event_count"))


def fact_monthly(
    statistics: DataFrame,
    facts: DataFrame,
    sentiments: DataFrame,
    trend: DataFrame,
    weather: DataFrame,
    flight: DataFrame,
    events: DataFrame,
    first_year: int = 2020,
) -> DataFrame:
    """One row per monthly statistics row, with every other feed summed up to its month.

    Each feed is aggregated to (year, month) before it is joined, so the joins see months, not
    rows. Annual rows have no month and drop out.
    """
    spine = statistics.where(
        (F.col("stat_year") >= first_year) & F.col("stat_month").between(1, 12)
    ).select(
        F.col("stat_year").alias("year"), F.col("stat_month").alias("month"), *GUESTS, REVENUE
    )
    searches = trend.groupBy(*_month_of("report_date")).agg(
        F.avg("search_interest").alias("avg_search_interest"))
    climate = rollup_spec(weather, _month_of("weather_date"), {
        c: ("avg", c) for c in ("temp_mean_celsius", "rainfall_mm", "wind_speed_max")})
    flights = rollup_spec(flight, _month_of("flight_date"), {
        c: ("sum", c) for c in ("domestic_flights", "international_flights", "total_flights")})
    joined = left_join_all(
        spine,
        [news_by_month(facts, sentiments), searches, climate, flights,
         event_days_by_month(events)],
        MONTH,
    )
    counts = ("news_count", "positive_news", "neutral_news", "negative_news")
    return joined.select(
        L.month_start(F.col("year"), F.col("month")).alias("report_date"),
        "year", "month", F.lit(1).cast("bigint").alias("day"),
        *[L.default(F.col(c), 0).alias(c) for c in counts],
        "avg_search_interest", "temp_mean_celsius", "rainfall_mm", "wind_speed_max",
        "domestic_flights", "international_flights", "total_flights",
        L.default(F.col("event_count"), 0).alias("event_count"),
        *GUESTS, REVENUE,
    )


def monthly_mart(fact: DataFrame) -> DataFrame:
    """Flows summed, rates averaged, levels at their maximum, per month.

    ``rainfall_mm`` is already a monthly average, so ``total_rainfall`` is that average.
    """
    return rollup_spec(fact, MONTH, {
        "total_news": ("sum", "news_count"),
        "avg_search_interest": ("avg", "avg_search_interest"),
        "avg_temperature": ("avg", "temp_mean_celsius"),
        "total_rainfall": ("sum", "rainfall_mm"),
        "max_wind_speed": ("max", "wind_speed_max"),
        "total_domestic_flights": ("sum", "domestic_flights"),
        "total_international_flights": ("sum", "international_flights"),
        "total_flights": ("sum", "total_flights"),
        "total_events": ("sum", "event_count"),
        **{c: ("max", c) for c in (*GUESTS, REVENUE)},
    })


# Weights, thresholds and factors of the two indexes and the scenarios.
INDEX_A_WEIGHTS = {
    "visitor_score": 0.30, "revenue_score": 0.25, "flight_score": 0.20,
    "search_score": 0.15, "event_score": 0.10,
}
INDEX_A_BANDS = [(80, "Excellent"), (60, "Good"), (40, "Moderate")]
INDEX_A_LOWEST = "Poor"
INDEX_B_WEIGHTS = {
    "demand_score": 0.30, "mobility_score": 0.25, "environment_score": 0.15,
    "event_score": 0.15, "sentiment_score": 0.15,
}
INDEX_B_BANDS = [(80, "Healthy"), (60, "Watch"), (40, "Warning")]
INDEX_B_LOWEST = "Critical"
SCENARIOS = {
    "Baseline": {},
    "High Demand": {"demand_score": 1.20},
    "Festival Season": {"event_score": 1.5},
}
INDEX = "tourism_health_index"


def health_index_a(fact: DataFrame) -> DataFrame:
    """Index over five scaled measures. A missing measure leaves the index NULL, so ``Poor``."""
    measures = {
        "visitor_score": "accommodation_guests", "revenue_score": REVENUE,
        "flight_score": "total_flights", "search_score": "avg_search_interest",
        "event_score": "event_count",
    }
    rows = fact.select("report_date", "year", "month", "day", *measures.values())
    return (
        minmax_scale(rows, measures)
        .withColumn(INDEX, L.weighted_index(INDEX_A_WEIGHTS))
        .withColumn("health_status", L.band(F.col(INDEX), INDEX_A_BANDS, INDEX_A_LOWEST))
    )


def health_index_b(fact: DataFrame) -> DataFrame:
    """Index over five scores, missing ones being 0. It is computed from unrounded scores, but
    for the sentiment score, which is a percentage rounded to two digits."""
    fractions = {
        "_demand": "avg_search_interest", "_mobility": "total_flights",
        "_warm": "temp_mean_celsius", "_dry": "rainfall_mm", "_calm": "wind_speed_max",
        "_event": "event_count",
    }
    scaled = minmax_scale(fact, fractions, scale=1.0, null_to=0.0, invert=["_dry", "_calm"])
    scores = scaled.select(
        "report_date", "year", "month",
        (F.col("_demand") * 100).alias("demand_score"),
        (F.col("_mobility") * 100).alias("mobility_score"),
        L.mean_of(F.col("_warm"), F.col("_dry"), F.col("_calm"), scale=100)
        .alias("environment_score"),
        (F.col("_event") * 100).alias("event_score"),
        L.share(F.col("positive_news"), F.col("news_count")).alias("sentiment_score"),
    ).withColumn(INDEX, L.weighted_index(INDEX_B_WEIGHTS))
    return scores.select(
        "report_date", "year", "month",
        *[F.round(c, 2).alias(c) for c in INDEX_B_WEIGHTS],
        INDEX,
        L.band(F.col(INDEX), INDEX_B_BANDS, INDEX_B_LOWEST).alias("health_status"),
    )


def scenario_table(index_b: DataFrame) -> DataFrame:
    """Three rows per month, computed from the rounded scores."""
    return scenarios(index_b, SCENARIOS, INDEX_B_WEIGHTS, INDEX, ids=["report_date"])
