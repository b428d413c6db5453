"""Explicit schemas of the bronze feeds."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, DataType, DateType, DoubleType, LongType, StringType, StructField, StructType,
    TimestampType,
)

TEXT, WHOLE, REAL, DAY, MOMENT = (
    StringType(), LongType(), DoubleType(), DateType(), TimestampType()
)


def _schema(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


FLIGHT = _schema(
    flight_date=DAY, domestic_flights=WHOLE, international_flights=WHOLE, total_flights=WHOLE,
    data_source=TEXT,
)
WEATHER = _schema(
    date=DAY, temp_mean=REAL, temp_max=REAL, temp_min=REAL, rainfall_mm=REAL, wind_speed_max=REAL,
    source=TEXT,
)
STATISTICS = _schema(
    year=WHOLE, month=WHOLE, period_type=TEXT, accommodation_guests=WHOLE,
    accommodation_intl_guests=WHOLE, accommodation_domestic_guests=WHOLE,
    tourism_revenue_billion_vnd=REAL,
)
# The article feeds are read as text and typed on load.
NEWS_FEED = _schema(
    article_id=TEXT, publish_date=TEXT, title=TEXT, summary=TEXT, url=TEXT, source=TEXT,
    source_system=TEXT, crawl_time=TEXT,
)
NEWS = _schema(
    article_id=TEXT, publish_date=DAY, title=TEXT, summary=TEXT, url=TEXT, source=TEXT,
    source_system=TEXT, crawl_time=MOMENT, sentiment_score=WHOLE, sentiment_label=TEXT,
)
TRENDS = _schema(
    search_date=DAY, keyword=TEXT, search_interest=WHOLE, source=TEXT, source_system=TEXT,
    crawl_time=MOMENT,
)
EVENT = _schema(
    event_name=TEXT, start_date=TEXT, end_date=TEXT, location=TEXT, category=TEXT,
)

# The weather service answers with one array per measure.
WEATHER_RESPONSE = _schema(daily=_schema(
    time=ArrayType(TEXT), temperature_2m_mean=ArrayType(REAL), temperature_2m_max=ArrayType(REAL),
    temperature_2m_min=ArrayType(REAL), precipitation_sum=ArrayType(REAL),
    wind_speed_10m_max=ArrayType(REAL),
))
# One object of the JSON article list.
ARTICLE_OBJECT = _schema(
    Title=TEXT, Headlines=TEXT, LinktoMe2=TEXT, Time_yyyyMMddHHmmss=TEXT, PublisherId=TEXT,
)
