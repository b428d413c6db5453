"""The models on trap rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakesteps import schemas
from lakesteps.operators import check, word_list_scorer
from lakesteps.operators.quality import SILVER_RULES
from lakesteps.plans import (
    build_gold, build_silver, check_silver, dim_event, dim_location, fact_news,
    monthly_mart, news_bronze, refresh_articles, silver_events,
    silver_flight, silver_news, silver_statistics, silver_trend, silver_weather, trend_refresh,
    weather_bronze,
)
from lakesteps.plans.bronze import NEWS_REQUIRED, trend_long
from lakesteps.sources import Catalog, export_csv

D, T = dt.date, dt.datetime


@pytest.fixture(scope="module")
def bronze(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    return {
        "flight": frame([
            (D(2025, 2, 1), 10, 5, 99, "a"), (D(2025, 2, 1), 11, None, 100, "a"), (D(2025, 2, 2), None, None, None, "a"),
            (None, 1, 1, 2, "a"), (D(2025, 3, 1), 30, 20, 50, "a")], schemas.FLIGHT),
        "weather": frame([
            (D(2025, 2, 1), 20.0, 30.0, 10.0, 1.0, 3.0, "archive_api"), (D(2025, 2, 1), 21.55, 30.0, 10.0, 2.0, 4.0, "live"),
            (D(2025, 2, 2), None, 31.0, 22.5, None, None, "live"), (D(2025, 3, 1), 25.0, 30.0, 20.0, 0.0, 1.0, "live")],
            schemas.WEATHER),
        "tourism_stats": frame([
            (2025, None, "annual", 900, 1, 1, 9.0), (2025, 2, "monthly", 50, 20, 30, 4775.0), (2025, 2, "monthly", 40, 20, 20, None),
            (2025, 3, "monthly", 100, 60, 40, None), (2025, 4, "monthly", None, None, None, None),
            (2019, 1, "monthly", 5, 1, 4, 1.0), (2025, None, "cumulative_2thang", 7, 1, None, None),
            (None, 1, "monthly", 1, 1, 1, 1.0)], schemas.STATISTICS),
        "news": frame([
            (" a1", D(2025, 2, 3), " Title ", "s ", " http://x/1 ", "SRC ", "Api", T(2025, 3, 1), -1, "Tiêu cực"),
            ("a1", D(2025, 2, 3), "New", "s", "http://x/1", "src", "api", T(2025, 3, 2), 1, "Tích cực"),
            ("a2", D(2025, 2, 4), "T2", None, "http://x/2", "src", "api", T(2025, 3, 1), None, None),
            ("a3", D(2025, 3, 4), "T3", "s", "http://x/3", "src", "api", T(2025, 3, 5), 0, "Trung lập"),
            (None, D(2025, 2, 4), "T", "s", "http://x/4", "s", "a", T(2025, 3, 1), 1, "Tích cực"),
            ("a5", None, "T", "s", "http://x/5", "s", "a", T(2025, 3, 1), 1, "Tích cực")], schemas.NEWS),
        "google_trends": frame([
            (D(2025, 2, 1), " DaNang ", 40, "Google", "PyTrends", T(2025, 2, 2)), (D(2025, 2, 2), "danang", 60, "g", "p", T(2025, 2, 2)),
            (D(2025, 3, 2), "danang", 90, "g", "p", T(2025, 2, 2)), (D(2025, 3, 2), None, 1, "g", "p", T(2025, 2, 2)),
            (D(2025, 3, 2), "x", None, "g", "p", T(2025, 2, 2))], schemas.TRENDS),
        "event": frame([
            ("Full", "2025-02-27", "2025-03-02", "Beach", "MUSIC show"), ("Month", "2020-10", "2021-04", "Hall", "Tourism"),
            ("Quarter", "2024-Q2", "2024-Q2", "Park", "Music"), ("Year", "2024", "2024", "Park", "Music"),
            ("Open end", "2025-02-01", None, None, "Culture"), (None, "2025-01-01", "2025-01-01", "Beach", "x"),
            ("Reversed", "2025-03-05", "2025-03-01", "Beach", "x")], schemas.EVENT),
    }


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def test_silver_flight(bronze):
    got = rows(silver_flight(bronze["flight"]), "flight_date", "domestic_flights", "international_flights", "total_flights")
    assert got == [(D(2025, 2, 1), 11, 0, 11), (D(2025, 2, 2), 0, 0, 0), (D(2025, 3, 1), 30, 20, 50)]


def test_silver_weather_keeps_the_hottest_version(bronze):
    got = rows(silver_weather(bronze["weather"]), "weather_date", "temp_mean_celsius", "rainfall_mm", "wind_speed_max")
    assert got == [(D(2025, 2, 1), 21.6, 2.0, 4.0), (D(2025, 2, 2), 26.8, 0.0, 0.0), (D(2025, 3, 1), 25.0, 0.0, 1.0)]


def test_silver_statistics(bronze):
    silver = silver_statistics(bronze["tourism_stats"])
    assert rows(silver.where("stat_id is null"), "period_type") == [("annual",), ("cumulative_2thang",)]
    assert rows(silver.where("stat_id = '2025-2-monthly'"), "accommodation_guests", "tourism_revenue_billion_vnd") == [(50, 4775.0)]
    assert rows(silver.where("stat_id = '2025-4-monthly'"), "accommodation_guests", "tourism_revenue_billion_vnd") == [(0, 0.0)]
    report = {(r.rule, r.column): r.failures for r in check(silver, SILVER_RULES["stg_tourism_stats_cleansed"]).collect()}
    assert report == {("unique", "stat_id"): 0, ("not_null", "stat_id"): 2, ("not_null", "accommodation_guests"): 0}


def test_silver_news(bronze):
    got = rows(silver_news(bronze["news"]), "article_id", "title", "url", "title_length", "summary_length", "sentiment_score", "sentiment_label")
    assert got == [("a1", "New", "http://x/1", 3, 1, 1, "Tích cực"), ("a2", "T2", "http://x/2", 2, None, 0, "Uncategorized"),
                   ("a3", "T3", "http://x/3", 2, 1, 0, "Trung lập")]


def test_silver_trend_key_uses_the_raw_keyword(spark, bronze):
    got = silver_trend(bronze["google_trends"])
    assert rows(got, "keyword", "search_interest", "source", "year_month") == [
        ("danang", 40, "google", "2025-02"), ("danang", 60, "g", "2025-02"), ("danang", 90, "g", "2025-03")]
    raw = spark.range(1).select(F.md5(F.lit("2025-02-01_ DaNang "))).first()[0]
    assert raw in {r.trend_id for r in got.collect()}


def test_silver_events(bronze):
    got = rows(silver_events(bronze["event"]), "event_name", "start_date", "end_date", "category", "duration_days", "event_year")
    assert got == [
        ("Full", D(2025, 2, 27), D(2025, 3, 2), "Music Show", 4, 2025), ("Month", D(2020, 10, 1), D(2021, 4, 1), "Tourism", 183, 2020),
        ("Quarter", D(2024, 4, 1), D(2024, 4, 1), "Music", 1, 2024), ("Reversed", D(2025, 3, 5), D(2025, 3, 1), "X", -3, 2025),
        ("Year", D(2024, 1, 1), D(2024, 1, 1), "Music", 1, 2024)]


def test_event_dimension(bronze):
    events = bronze["event"].where("event_name is not null")
    places = dim_location(events)
    assert rows(places) == [(1, "Beach"), (2, "Hall"), (3, "Park")]
    got = rows(dim_event(events, places), "event_key", "event_name", "start_date", "location_key")
    assert got == [(1, "Month", None, 2), (2, "Quarter", None, 3), (3, "Year", None, 3), (4, "Open end", D(2025, 2, 1), None),
                   (5, "Full", D(2025, 2, 27), 1), (6, "Reversed", D(2025, 3, 5), 1)]
    repaired = dim_event(events, places, repair_dates=True)
    assert rows(repaired.where("start_date = '2024-04-01'"), "event_name") == [("Quarter",)]


@pytest.fixture(scope="module")
def built(spark, bronze, tmp_path_factory):
    catalog = Catalog(spark, str(tmp_path_factory.mktemp("gold")))
    views = build_silver(catalog, bronze)
    # the trap rows fail a test on purpose, which would stop the build
    return catalog, views, build_gold(catalog, views, bronze["event"], checked=False)


def test_failed_column_tests_stop_the_build(spark, bronze, tmp_path):
    catalog = Catalog(spark, str(tmp_path))
    views = build_silver(catalog, bronze)
    with pytest.raises(ValueError, match="column=stat_id, failures=2"):
        build_gold(catalog, views, bronze["event"])
    assert not list(tmp_path.iterdir())
    views["stg_tourism_stats_cleansed"] = views["stg_tourism_stats_cleansed"].where("stat_id is not null")
    assert "scenario_simulation" in build_gold(catalog, views, bronze["event"])


def test_build_registers_every_relation(built):
    catalog, views, gold = built
    assert set(gold) == {
        "dim_location", "dim_event", "dim_news", "dim_sentiment", "dim_time", "fact_news", "fact_tourism",
        "mart_tourism_data_mart", "mart_tourism_health_index", "tourism_health_index", "scenario_simulation"}
    assert all(catalog.source(name).count() > 0 for name in [*views, *gold])


def test_monthly_fact(built):
    fact = built[2]["fact_tourism"]
    got = {r.month: r for r in fact.collect()}
    assert sorted(got) == [2, 3, 4] and fact.where("year <> 2025").count() == 0
    feb, march, april = got[2], got[3], got[4]
    assert (feb.news_count, feb.positive_news, feb.neutral_news, feb.negative_news) == (2, 1, 0, 0)
    assert (feb.avg_search_interest, feb.total_flights, feb.day) == (50.0, 11, 1)
    # the full event has two days in February and two in March, the open one has one day
    assert (feb.event_count, march.event_count, april.event_count) == (3, 2, 0)
    assert (april.news_count, april.total_flights, april.avg_search_interest) == (0, None, None)
    assert feb.report_date == D(2025, 2, 1)


def test_indexes(built):
    gold = built[2]
    a = {r.month: r for r in gold["mart_tourism_health_index"].collect()}
    assert a[2].revenue_score == 100 and a[3].revenue_score == 0
    assert (a[4].tourism_health_index, a[4].health_status) == (None, "Poor")
    assert a[2].tourism_health_index == round(50 * 0.3 + 100 * 0.25 + 0 + 0 + 100 * 0.1, 2)
    b = {r.month: r for r in gold["tourism_health_index"].collect()}
    assert b[4].demand_score == 0 and b[2].sentiment_score == 50.0 and b[4].health_status == "Critical"
    # a missing measure counts as 0, so the inverted ones of April are 1
    assert b[4].environment_score == 66.67


def test_scenarios_keep_the_baseline(built):
    gold = built[2]
    stored = {r.report_date: r for r in gold["tourism_health_index"].collect()}
    for r in gold["scenario_simulation"].collect():
        s = stored[r.report_date]
        if r.scenario == "Baseline":
            assert r.tourism_health_index == s.tourism_health_index
        elif r.scenario == "High Demand":
            assert r.demand_score == s.demand_score * 1.20
        else:
            assert r.event_score == s.event_score * 1.5
    assert gold["scenario_simulation"].count() == 9


def test_fact_news_does_not_pair_links_that_share_an_id(spark):
    silver = silver_news(spark.createDataFrame([
        ("same", D(2025, 2, 3), "t", "s", f"http://x/{i}", "s", "a", T(2025, 3, 1), 1, "Tích cực") for i in range(4)], schemas.NEWS))
    from lakesteps.plans import calendar_dim, dim_news, dim_sentiment
    args = (silver, dim_news(silver), calendar_dim([silver.select("report_date")]), dim_sentiment(silver))
    assert fact_news(*args).count() == 4
    assert fact_news(*args, on=["article_id"]).count() == 16


def test_silver_checks(built):
    failed = built[1] and check_silver(built[1]).where("failures > 0")
    assert rows(failed, "relation", "rule", "column") == [("stg_tourism_stats_cleansed", "not_null", "stat_id")]


def test_mart_is_one_row_per_month(built):
    mart = monthly_mart(built[2]["fact_tourism"])
    assert mart.count() == 3 and len(mart.columns) == 15


# ---- article refresh

def test_refresh_articles(spark):
    ddl = "article_id string, publish_date date, title string, summary string, url string"
    old = spark.createDataFrame([("1", D(2024, 1, 1), "old", "s", "u1"), ("2", D(2024, 1, 2), "kept", "s", "u2")], ddl)
    found = spark.createDataFrame([
        ("4", D(2024, 1, 4), "new", "s", "u4", 0, 0), ("4x", D(2024, 1, 4), "seen", "s", "u4", 0, 1),
        ("1", D(2024, 1, 3), "again", "s", "u1b", 0, 2), ("2", D(2024, 1, 2), "known", "s", "u2", 1, 0),
        ("0", D(2023, 1, 1), "older", "s", "u0", 1, 1)], ddl + ", page int, pos int")
    articles, mark = refresh_articles(old, found, ["page", "pos"], "u2")
    assert rows(articles, "article_id", "title") == [("1", "again"), ("2", "kept"), ("4", "new")]
    got = mark.first()
    assert (got.last_article_id, got.last_article_url, got.last_publish_date, got.total_articles) == ("4", "u4", "2024-01-04", 3)
    unchanged, no_mark = refresh_articles(old, found, ["page", "pos"], "u4")
    assert rows(unchanged) == rows(old) and no_mark.isEmpty()
    assert refresh_articles(old, found, ["page", "pos"])[0].count() == 4


# ---- bronze loads

def test_weather_bronze(spark):
    def body(days, mean):
        listed = ", ".join(f'"2024-01-{d:02d}"' for d in days)
        same = ", ".join(str(mean) for _ in days)
        fields = ("temperature_2m_mean", "temperature_2m_max", "temperature_2m_min", "precipitation_sum", "wind_speed_10m_max")
        arrays = ", ".join(f'"{f}": [{same}]' for f in fields)
        return spark.createDataFrame([(f'{{"daily": {{"time": [{listed}], {arrays}}}}}',)], "body string")

    got = weather_bronze(body(range(1, 11), 1.0), body(range(5, 12), 2.0), D(2024, 1, 10))
    assert {r.date.day: r.source for r in got.collect()} == {
        d: "archive_api" if d < 8 else "live_forecast_api" for d in range(1, 11)}
    assert set(got.columns) == set(schemas.WEATHER.names)


def test_trend_refresh(spark):
    def group(ddl, data):
        return spark.createDataFrame(data, ddl)

    g1 = group("date date, anchor bigint, a bigint", [(D(2024, 1, 1), 1, 10), (D(2024, 1, 2), 2, None)])
    g2 = group("date date, anchor bigint, b bigint", [(D(2024, 1, 2), 9, 20), (D(2024, 1, 3), 9, 30)])
    stamp = F.lit("2024-02-01 00:00:00").cast("timestamp")
    old = trend_long([group("date date, anchor bigint, a bigint", [(D(2023, 12, 1), 5, 5), (D(2024, 1, 2), 7, 7)])],
                     "anchor", crawl_time=stamp)
    keywords = ["anchor", "a", "b"]
    long, wide, mark = trend_refresh(old, [g1, g2], (D(2024, 1, 1), D(2024, 1, 3)), "anchor", keywords, stamp)
    assert rows(long, "search_date", "keyword", "search_interest") == [
        (D(2023, 12, 1), "a", 5), (D(2023, 12, 1), "anchor", 5), (D(2024, 1, 1), "a", 10), (D(2024, 1, 1), "anchor", 1),
        (D(2024, 1, 2), "anchor", 2), (D(2024, 1, 2), "b", 20), (D(2024, 1, 3), "b", 30)]
    assert rows(wide.where("search_date = '2024-01-02'")) == [(D(2024, 1, 2), 2, None, 20)]
    assert mark.first().last_date == "2024-01-03"


def test_news_bronze(spark, tmp_path):
    def feed(name, data, cols=NEWS_REQUIRED):
        export_csv(spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols)).coalesce(1), str(tmp_path / name))
        return str(tmp_path / name)

    one = feed("one", [("1", "2024-05-01", "T", "good, news", "u1", "s", "sys", "2024-06-01 10:00:00"),
                       ("1b", "2024-05-02", "Dup", "bad", "u1", "s", "sys", "2024-06-01 10:00:00"),
                       ("2", "not a date", "T2", None, "u2", "s", "sys", "bad")])
    two = feed("two", [("3", "2024-05-03", "T3", "bad news", "u1", "other", "sys", "2024-06-01 10:00:00")])
    lacking = feed("three", [("x", "y")], ["article_id", "title"])
    paths = [one, str(tmp_path / "absent"), lacking, two]
    scorer = word_list_scorer(["good"], ["bad"])
    got = news_bronze(spark, paths, scorer)
    assert got.schema.names == schemas.NEWS.names
    assert rows(got, "article_id", "publish_date", "summary", "sentiment_score") == [
        ("1", D(2024, 5, 1), "good, news", 1), ("2", None, "", 0), ("3", D(2024, 5, 3), "bad news", -1)]
    # loaded once, the same history brings nothing; one changed title brings one row
    loaded = got.where("article_id <> '3'").union(got.where("article_id = '3'").withColumn("title", F.lit("Old")))
    assert rows(news_bronze(spark, paths, scorer, loaded), "article_id") == [("3",)]
    assert news_bronze(spark, [str(tmp_path / "absent")], scorer) is None
