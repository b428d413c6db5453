"""Column expressions on the traps they exist for."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakesteps import functions as L
from lakesteps.functions.text import DOMESTIC_AIRPORTS, LOCAL_TERMS


def values(spark, ddl, rows, expr):
    df = spark.createDataFrame(rows, ddl)
    return [r[0] for r in df.select(expr.alias("x")).collect()]


def on_text(spark, texts, fn):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, s string").coalesce(1)
    return [r[0] for r in df.orderBy("i").select(fn(F.col("s")).alias("x")).collect()]


D = dt.date


def test_partial_dates(spark):
    texts = ["2020-07-30", "2020-10", "2024-Q2", "2024-Q3", "2024-Q4", "2024", " 2021-04\xa0", "2024-13",
             "2024-02-30", "2024-Q5", "2024-5", "soon", "", None, "2024-05-01\n2"]
    assert on_text(spark, texts, L.parse_partial_date) == [
        D(2020, 7, 30), D(2020, 10, 1), D(2024, 4, 1), D(2024, 7, 1), D(2024, 10, 1), D(2024, 1, 1),
        D(2021, 4, 1), None, None, None, None, None, None, None, None]


def test_strict_date_takes_full_days_only(spark):
    assert on_text(spark, ["2024-05-01", "2024-05", "2024", "2024-02-30", "x", None], L.parse_date_strict) == [
        D(2024, 5, 1), None, None, None, None, None]


def test_week_is_sunday_based(spark):
    days = ["2023-01-01", "2024-01-01", "2024-01-06", "2024-01-07", "2022-12-31"]
    assert on_text(spark, days, lambda c: L.week_sunday(c.cast("date"))) == [1, 0, 0, 1, 52]


def test_week_agrees_with_strftime(spark):
    df = spark.sql("select explode(sequence(date'1995-01-01', date'2030-12-31')) as d")
    got = df.select("d", L.week_sunday(F.col("d")).alias("w")).collect()
    assert all(r.w == int(r.d.strftime("%U")) for r in got)


def test_weekend_and_names(spark):
    assert on_text(spark, ["2024-01-06", "2024-01-07", "2024-01-08"], lambda c: L.is_weekend(c.cast("date"))) == [
        True, True, False]
    assert on_text(spark, ["2024-01-06"], lambda c: L.day_name(c.cast("date"))) == ["Saturday"]
    assert on_text(spark, ["2024-01-06"], lambda c: L.year_month(c.cast("date"))) == ["2024-01"]


def test_epoch_dates(spark):
    texts = ["0", "1704067199", " 1704067200 ", "junk", "", None, "99999999999999999", "-1"]
    assert on_text(spark, texts, L.epoch_to_date) == [
        D(1970, 1, 1), D(2023, 12, 31), D(2024, 1, 1), None, None, None, None, D(1969, 12, 31)]
    assert on_text(spark, ["1704045600"], lambda c: L.epoch_to_date(c, "Asia/Bangkok")) == [D(2024, 1, 1)]


def test_epoch_date_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert on_text(spark, ["1704067200"], L.epoch_to_date) == [D(2024, 1, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_iso_and_heading_dates(spark):
    assert on_text(spark, ["2024-05-01T10:20:30", "2024-05-01", "x", None], L.iso_to_date) == [
        D(2024, 5, 1), None, None, None]
    headings = ["Wednesday, May 1", "Thursday, Dec 31", "May 1", "x, y", None]
    assert on_text(spark, headings, lambda c: L.heading_to_date(c, F.lit(2024))) == [
        D(2024, 5, 1), D(2024, 12, 31), None, None, None]


def test_parse_or_null(spark):
    assert on_text(spark, ["2024-05-01", "01/05/2024", "x"], lambda c: L.parse_or_null(
        c, ["yyyy-MM-dd", "dd/MM/yyyy"])) == [D(2024, 5, 1), D(2024, 5, 1), None]


def test_trim_takes_unicode_spaces(spark):
    assert on_text(spark, ["\xa0 Đà Nẵng　\t", " ", None], L.trim_ws) == ["Đà Nẵng", "", None]


def test_clean_text_keeps_accents(spark):
    text = "<p class='a'>Hạ tầng</p>, du lịch!\n\nxuống_cấp <b\n> 100% ½"
    assert on_text(spark, [text, "...", None], L.clean_text) == [
        "Hạ tầng du lịch xuống_cấp b 100 ½", "", None]


def test_contains_any(spark):
    df = spark.createDataFrame(
        [("Lễ hội ĐÀ NẴNG", None), ("bãi biển mỹ", "khê đẹp"), ("Hà Nội", "x"), (None, None)],
        "title string, summary string")
    hit = L.contains_any([F.col("title"), F.col("summary")], LOCAL_TERMS)
    assert [r[0] for r in df.select(hit).collect()] == [True, True, False, False]


def test_membership_class(spark):
    got = on_text(spark, ["HAN", "SIN", None], lambda c: L.class_by_membership(
        c, DOMESTIC_AIRPORTS, "domestic", "international"))
    assert got == ["domestic", "international", "international"]
    assert len(set(DOMESTIC_AIRPORTS)) == 21


def test_keys(spark):
    assert on_text(spark, ["a", None], lambda c: L.surrogate_key([c, F.lit(1)])) == [
        on_text(spark, ["a_1"], F.md5)[0], None]
    assert on_text(spark, ["a", None], lambda c: L.joined_key([F.lit(2024), c, F.lit("monthly")])) == [
        "2024-a-monthly", None]
    xx = on_text(spark, ["a", "b", None], lambda c: L.surrogate_key([c], method="xxhash64"))
    assert xx[0] != xx[1] and xx[2] is None
    with pytest.raises(ValueError):
        L.surrogate_key([F.lit("a")], method="crc")


def test_links_and_fallbacks(spark):
    assert on_text(spark, ["/a", "http://b/a", None], lambda c: L.absolute_url(c, "http://h")) == [
        "http://h/a", "http://b/a", None]
    assert on_text(spark, ["", None, "t"], lambda c: L.first_non_empty(c, F.lit("x"))) == ["x", "x", "t"]
    assert on_text(spark, [""], lambda c: L.first_non_empty(c, F.lit(None).cast("string"))) == [""]


def test_band_sends_null_to_the_last(spark):
    bands = [(80, "Excellent"), (60, "Good"), (40, "Moderate")]
    rows = [(x,) for x in (80.0, 79.99, 60.0, 40.0, 39.0, None)]
    assert values(spark, "x double", rows, L.band(F.col("x"), bands, "Poor")) == [
        "Excellent", "Good", "Good", "Moderate", "Poor", "Poor"]


def test_numbers(spark):
    x = F.col("x")
    assert values(spark, "x double", [(2.5,), (-2.5,), (2.4,), (None,)], L.to_long(x)) == [3, -3, 2, None]
    rows = [(20.04, 30.0, 10.0), (None, 31.0, 22.5), (None, None, 1.0)]
    mean = L.fallback_mean(F.col("a"), F.col("b"), F.col("c"))
    assert values(spark, "a double, b double, c double", rows, mean) == [20.0, 26.8, None]
    assert values(spark, "a bigint, b bigint", [(1, 2), (None, 2), (None, None)],
                  L.total(F.col("a"), F.col("b"))) == [3, 2, 0]
    assert values(spark, "a bigint, b bigint", [(1, 3), (1, 0), (None, 2), (2, None)],
                  L.share(F.col("a"), F.col("b"))) == [33.33, 0.0, 0.0, 0.0]
    assert values(spark, "a double, b double", [(10.0, 20.0), (None, 1.0)],
                  L.weighted_index({"a": 0.3, "b": 0.7})) == [17.0, None]
    assert values(spark, "x int", [(1,)], L.mean_of(x, x, x * 4, scale=100)) == [200.0]
    assert values(spark, "x int", [(5,), (1,), (None,)],
                  L.first_match([(x > 3, "big"), (x > 0, "small")], "none")) == ["big", "small", "none"]


def test_count_where(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "i int, c string")
    assert df.agg(L.count_where(F.col("c") == "a")).first()[0] == 2
    assert df.where("i > 9").agg(L.count_where(F.col("c") == "a")).first()[0] is None
