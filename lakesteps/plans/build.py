"""The whole build: bronze tables to silver views to gold tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from lakesteps.operators.quality import SILVER_RULES, check, require_checks
from lakesteps.operators.rollup import union_all
from lakesteps.plans import gold, silver
from lakesteps.session import materialize
from lakesteps.sources.catalog import Catalog


def build_silver(catalog: Catalog, bronze: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Register the six silver views over the six bronze tables."""
    makers = {
        "stg_flight_cleansed": (silver.silver_flight, "flight"),
        "stg_weather_cleansed": (silver.silver_weather, "weather"),
        "stg_tourism_stats_cleansed": (silver.silver_statistics, "tourism_stats"),
        "stg_news_cleansed": (silver.silver_news, "news"),
        "stg_trend_cleansed": (silver.silver_trend, "google_trends"),
        "stg_events_cleansed": (silver.silver_events, "event"),
    }
    return {
        name: catalog.view(name, make(bronze[feed])) for name, (make, feed) in makers.items()
    }


def check_silver(views: Mapping[str, DataFrame]) -> DataFrame:
    """All column tests: ``(relation, rule, column, failures)``."""
    return union_all([
        check(df, SILVER_RULES[name]).select(F.lit(name).alias("relation"), "*")
        for name, df in views.items()
    ])


def build_gold(
    catalog: Catalog, views: Mapping[str, DataFrame], events: DataFrame,
    repair_event_dates: bool = False, checked: bool = True,
) -> dict[str, DataFrame]:
    """Build every gold table in the order of its inputs.

    A failed column test of the silver views stops the build before the first table, unless
    ``checked`` is off. Each table is written once and read back, so the monthly fact is computed once for its three
    readers. The silver views that several tables read are computed once as well.
    """
    news, trend, weather, flight = (
        materialize(views[f"stg_{name}_cleansed"], f"silver-{name}")
        for name in ("news", "trend", "weather", "flight")
    )
    if checked:
        written = {"stg_news_cleansed": news, "stg_trend_cleansed": trend,
                   "stg_weather_cleansed": weather, "stg_flight_cleansed": flight}
        require_checks(check_silver({**views, **written}))
    built: dict[str, DataFrame] = {}

    def table(name: str, df: DataFrame, *order: str) -> DataFrame:
        built[name] = catalog.table(name, df, order)
        return built[name]

    locations = table("dim_location", gold.dim_location(events))
    event = table("dim_event", gold.dim_event(events, locations, repair_event_dates))
    articles = table("dim_news", gold.dim_news(news))
    sentiments = table("dim_sentiment", gold.dim_sentiment(news))
    calendar = table("dim_time", gold.calendar_dim([
        news.select("report_date"), trend.select("report_date"),
        weather.select("weather_date"), flight.select("flight_date"),
    ]), "date_key")
    facts = table("fact_news", gold.fact_news(news, articles, calendar, sentiments))
    monthly = table("fact_tourism", gold.fact_monthly(
        views["stg_tourism_stats_cleansed"], facts, sentiments, trend, weather, flight, event,
    ), "report_date")
    table("mart_tourism_data_mart", gold.monthly_mart(monthly), "year", "month")
    table("mart_tourism_health_index", gold.health_index_a(monthly))
    index_b = table("tourism_health_index", gold.health_index_b(monthly), "report_date")
    table("scenario_simulation", gold.scenario_table(index_b))
    return built
