"""Bronze loads: raw feeds to typed tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date as Date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakesteps import schemas
from lakesteps import functions as L
from lakesteps.functions.text import DOMESTIC_AIRPORTS
from lakesteps.operators.dedup import keep_first, keep_last
from lakesteps.operators.merge import backfill, new_or_changed, overwrite_window
from lakesteps.operators.reshape import (
    outer_join_all, pivot_last, unpivot_long, zip_arrays_to_rows,
)
from lakesteps.operators.rollup import class_counts
from lakesteps.operators.scoring import Scorer, score_text
from lakesteps.operators.select import with_lineage
from lakesteps.session import materialize
from lakesteps.sources.day_tables import patch_wide, refresh_days, stored_days
from lakesteps.sources.readers import union_feeds
from lakesteps.sources.writers import save_mark


def flight_bronze(
    arrivals: DataFrame, heading: str, origin: str, year: Column,
    data_source: str = "Flightradar24",
) -> DataFrame:
    """Arrivals under day headings (``Wednesday, May 1``) to one row of counts per day.

    Arrivals without a readable heading are left out, days without arrivals have no row.
    """
    kind = L.class_by_membership(F.col(origin), DOMESTIC_AIRPORTS, "domestic_flights", "international_flights")
    dated = arrivals.select(
        L.heading_to_date(F.col(heading), year).alias("flight_date"), kind.alias("_kind")
    ).where(F.col("flight_date").isNotNull())
    counts = class_counts(dated, "flight_date", "_kind", ["domestic_flights", "international_flights"])
    return counts.withColumnRenamed("total", "total_flights").withColumn("data_source", F.lit(data_source))


def weather_days(responses: DataFrame, col: str, source: str) -> DataFrame:
    """JSON responses with one array per measure to one row per day."""
    daily = F.from_json(F.col(col), schemas.WEATHER_RESPONSE).getField("daily")
    rows = zip_arrays_to_rows(
        responses,
        {
            "date": daily.getField("time"),
            "temp_mean": daily.getField("temperature_2m_mean"),
            "temp_max": daily.getField("temperature_2m_max"),
            "temp_min": daily.getField("temperature_2m_min"),
            "rainfall_mm": daily.getField("precipitation_sum"),
            "wind_speed_max": daily.getField("wind_speed_10m_max"),
        },
        {"source": source},
    )
    return rows.withColumn("date", F.to_date("date"))


def weather_bronze(
    archive: DataFrame, live: DataFrame, run_day: Date | Column, col: str = "body",
    loaded: DataFrame | None = None,
) -> DataFrame:
    """Settled archive days plus the last live days, the live reading winning.

    With the ``loaded`` table given, only days it lacks or holds with other values are returned.
    """
    measures = ["temp_mean", "temp_max", "temp_min", "rainfall_mm", "wind_speed_max"]
    rows = backfill(
        weather_days(archive, col, "archive_api"),
        weather_days(live, col, "live_forecast_api"),
        "date", run_day, ordinal=measures,
    )
    return rows if loaded is None else new_or_changed(loaded, rows, ["date"])


NEWS_REQUIRED = schemas.NEWS_FEED.names
NEWS_KEY = ["source", "url"]


def score_news(rows: DataFrame, scorer_factory: Callable[[], Scorer]) -> DataFrame:
    """Feed rows to the news schema: dates parsed or NULL, summaries scored."""
    typed = rows.withColumns({
        "publish_date": F.to_date(F.try_to_timestamp("publish_date")),
        "crawl_time": F.try_to_timestamp("crawl_time"),
        "summary": F.coalesce("summary", F.lit("")),
    })
    scored = score_text(typed, "summary", scorer_factory, score="sentiment_score",
                        label="sentiment_label")
    return scored.select(*[F.col(f.name).cast(f.dataType) for f in schemas.NEWS.fields])


def news_updates(rows: DataFrame, order: Sequence[str], loaded: DataFrame | None) -> DataFrame:
    """First row per (source, link) in input order, less those ``loaded`` already holds as they are.

    Of several loaded versions the latest counts. The load time is not a change.
    """
    unique = keep_first(rows, NEWS_KEY, order).withColumn("summary", F.coalesce("summary", F.lit("")))
    if loaded is None:
        return unique
    content = ["title", "summary", "source_system"]
    current = keep_last(loaded, NEWS_KEY, ["crawl_time", "publish_date", *content])
    return new_or_changed(
        current, unique, NEWS_KEY,
        ignore=[c for c in unique.columns if c not in content],
    )


def news_bronze(
    spark: SparkSession,
    paths: Sequence[str],
    scorer_factory: Callable[[], Scorer],
    loaded: DataFrame | None = None,
) -> DataFrame | None:
    """Rows to append to the news table; None if no feed was usable.

    Feeds hold their whole history. With the ``loaded`` table given, only rows that are new or
    changed are scored and returned, so the table does not grow by the history on each run.
    """
    rows, _ = union_feeds(spark, paths, NEWS_REQUIRED)
    if rows is None:
        return None
    return score_news(news_updates(rows, ["_feed", "_line"], loaded), scorer_factory)


# Lineage labels, and the keyword groups with the keyword they share.
TREND_SOURCE, TREND_SYSTEM = "google_trends", "pytrends"
TREND_ANCHOR = "danang"
TREND_GROUPS = {
    "group_1": ["danang", "danang city", "da nang vietnam", "da nang travel"],
    "group_2": ["danang", "bana hills danang", "dragon bridge da nang", "lady buddha danang",
                "marble mountain da nang"],
    "group_3": ["danang", "da nang hotel", "danang beach hotel", "da nang resort",
                "hotel in da nang"],
    "group_4": ["danang", "danang international airport", "motorbike rental da nang",
                "danang airport transfer"],
    "group_5": ["danang", "son tra night market", "danang beach", "things to do in da nang",
                "weather da nang"],
}
TREND_KEYWORDS = list(dict.fromkeys(k for group in TREND_GROUPS.values() for k in group))


def trend_long(
    groups: Sequence[DataFrame], anchor: str = TREND_ANCHOR, date: str = "date",
    crawl_time: Column | None = None,
) -> DataFrame:
    """Wide keyword groups that share an anchor keyword to one row per day and keyword."""
    wide = outer_join_all(groups, date, anchor)
    keywords = [c for c in wide.columns if c != date]
    long = unpivot_long(wide, [date], keywords, "keyword", "search_interest")
    typed = long.select(
        F.to_date(date).alias("search_date"), "keyword",
        F.col("search_interest").cast("bigint").alias("search_interest"),
    )
    return with_lineage(typed, TREND_SOURCE, TREND_SYSTEM, crawl_time)


def trend_refresh(
    old: DataFrame | None,
    groups: Sequence[DataFrame],
    window: tuple[Date, Date],
    anchor: str = TREND_ANCHOR,
    keywords: Sequence[str] = TREND_KEYWORDS,
    crawl_time: Column | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Reload a window of days: ``(long table, wide table, mark)``.

    The merged rows are written once; the wide table and the mark are made from them. The mark is
    a one-row frame to be saved after the tables. Rows of one day and keyword within
    the new groups are unique, as the outer join has merged them.
    """
    new = trend_long(groups, anchor, crawl_time=crawl_time)
    keys = ["search_date", "keyword"]
    long = new if old is None else overwrite_window(old, new, "search_date", window[0], keys)
    long = materialize(
        long.withColumn("search_interest", L.to_long(F.col("search_interest"))), "trend-long")
    wide = pivot_last(long, "search_date", "keyword", "search_interest", keywords, ["search_date"])
    mark = long.agg(F.max("search_date").cast("string").alias("last_date"))
    return long, wide, mark


def trend_refresh_days(
    spark: SparkSession,
    root: str,
    groups: Sequence[DataFrame],
    window: tuple[Date, Date],
    anchor: str = TREND_ANCHOR,
    keywords: Sequence[str] = TREND_KEYWORDS,
    crawl_time: Column | None = None,
) -> tuple[T.StructType, T.StructType]:
    """``trend_refresh`` on stored tables: ``root/long`` and ``root/wide`` by day, and ``root/mark``.

    Of both tables only the days of the window, and earlier ones that the groups name, are read or
    written; the cost follows the window and not the history. Returns the schemas to read them with.
    """
    new = trend_long(groups, anchor, crawl_time=crawl_time)
    new = new.withColumn("search_interest", L.to_long(F.col("search_interest")))
    long, wide = f"{root.rstrip('/')}/long", f"{root.rstrip('/')}/wide"
    days = refresh_days(new, long, "search_date", window[0], ["search_date", "keyword"])
    schema = patch_wide(spark, long, new.schema, wide, days, "search_date", "keyword", "search_interest", keywords)
    last = max((d for d in stored_days(spark, long, "search_date") if d), default=None)
    if last is not None:
        save_mark(spark.createDataFrame([(last.isoformat(),)], "last_date string"), f"{root.rstrip('/')}/mark")
    return new.schema, schema
