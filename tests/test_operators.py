"""Operators on small frames, against plain Python where that is clearer."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import Observation, functions as F

from lakesteps.operators import (
    backfill, check, class_counts, dense_key, distinct_values, explode_days, explode_json_records,
    explode_months, extract_records, high_water, keep_first, keep_last, keep_one, lookup_dim,
    merge_new_first, minmax_scale, missing_columns, new_or_changed, newest, newest_first, not_null,
    outer_join_all, overwrite_window, pivot_last, priority_union, project, reprocess_window,
    require_text, rollup_spec, scenarios, score_text, take_until_marker, union_all, union_distinct,
    unique, unique_columns, unpivot_long, with_global_stats, with_lineage, word_list_label,
    word_list_scorer, zip_arrays_to_rows,
)
from lakesteps.operators.records import LISTING_EPOCH, LISTING_ISO
from lakesteps.operators.scoring import model_input
from lakesteps.schemas import ARTICLE_OBJECT

D = dt.date


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan(df):
    """The plan before execution, whether or not ``df`` has run."""
    return df.select("*")._jdf.queryExecution().executedPlan().toString()


# ---- one row per key

@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share one key."""
    rnd = random.Random(5)
    data = [(0 if rnd.random() < 0.34 else rnd.randrange(1, 60), rnd.randrange(500), i) for i in range(3000)]
    return spark.createDataFrame(data, "k int, v int, i int").repartition(8)


def test_keep_one_equals_brute_force_on_a_hot_key(hot):
    kept = keep_one(hot, ["k"], [F.desc("v"), F.asc("i")])
    best = {}
    for k, v, i in hot.collect():
        if k not in best or (-v, i) < (-best[k][1], best[k][2]):
            best[k] = (k, v, i)
    assert rows(kept) == sorted(best.values(), key=str)
    assert rows(keep_one(kept, ["k"], [F.desc("v"), F.asc("i")])) == rows(kept)
    # the partial limit before the exchange is what keeps a hot key from being sent whole
    text = plan(kept)
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_keep_first_last_and_priority(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z"), (None, 4, "n"), (None, 5, "m")],
                               "k string, o int, v string")
    assert rows(keep_first(df, ["k"], ["o"])) == rows(df.where("o in (1, 3, 4)"))
    assert rows(keep_last(df, ["k"], ["o"])) == rows(df.where("o in (2, 3, 5)"))
    low = spark.createDataFrame([(1, "low"), (2, "low")], "k int, v string")
    high = spark.createDataFrame([(2, "high"), (3, "high")], "k int, v string")
    assert rows(priority_union([low, high], ["k"])) == [(1, "low"), (2, "high"), (3, "high")]


# ---- merges

NEWS = "article_id string, publish_date string, title string"


def test_merge_new_first(spark):
    old = spark.createDataFrame([("1", "2024-01-01", "old"), ("2", "2024-01-02", "kept")], NEWS)
    new = spark.createDataFrame([("1", "2024-02-01", "new"), ("3", "bad", "odd"), ("4", "2024-03-01", None)], NEWS)
    merged = merge_new_first(old, new, "article_id", "publish_date", drop_blank_title=True)
    assert rows(merged) == [("1", D(2024, 2, 1), "new"), ("2", D(2024, 1, 2), "kept"), ("3", None, "odd")]
    assert merge_new_first(old, new, "article_id", "publish_date").count() == 4
    assert [r[0] for r in newest_first(merged, "publish_date").collect()] == ["1", "2", "3"]
    # without new rows nothing goes, not even repeated keys and blank titles
    old = old.union(spark.createDataFrame([("2", "2024-01-02", None)], NEWS))
    same = merge_new_first(old, new.limit(0), "article_id", "publish_date", drop_blank_title=True)
    assert rows(same) == rows(old.withColumn("publish_date", F.to_date("publish_date")))


def test_merges_leave_no_tie_open(spark):
    old = spark.createDataFrame([("1", "2024-01-01", "b"), ("1", "2024-01-01", "a")], NEWS)
    new = spark.createDataFrame([("1", "2024-02-01", t) for t in "cba"], NEWS)
    assert rows(merge_new_first(old, new, "article_id", "publish_date")) == [("1", D(2024, 2, 1), "a")]
    ddl = "d date, k string, v int"
    day = spark.createDataFrame([(D(2024, 1, 5), "k", v) for v in (2, 9, 4)], ddl)
    assert rows(overwrite_window(day.limit(0), day, "d", D(2024, 1, 1), ["d", "k"])) == [(D(2024, 1, 5), "k", 9)]


def test_outer_join_refuses_repeated_keys(spark):
    a = spark.createDataFrame([(1, 5), (1, 6)], "k int, x int")
    b = spark.createDataFrame([(1, 7)], "k int, y int")
    assert rows(outer_join_all([b, a.limit(1)], "k")) == [(1, 7, 5)]
    with pytest.raises(Exception, match="repeated k: 1"):
        outer_join_all([b, a], "k").collect()


def test_changes_of_a_microsecond_and_of_null_are_seen(spark):
    ddl = "k int, t timestamp, s string"
    at = dt.datetime(2024, 1, 1)
    old = spark.createDataFrame([(1, at, "a"), (2, at, None), (3, at, ""), (4, at, "x")], ddl)
    later = at + dt.timedelta(microseconds=1)
    new = spark.createDataFrame([(1, later, "a"), (2, at, ""), (3, at, None), (4, at, "x"), (5, at, "n")], ddl)
    assert [r[0] for r in rows(new_or_changed(old, new, ["k"]))] == [1, 2, 3, 5]


def test_overwrite_window_is_idempotent(spark):
    ddl = "d date, k string, v int"
    old = spark.createDataFrame([(D(2024, 1, 1), "a", 1), (D(2024, 1, 5), "a", 2), (D(2024, 1, 6), "b", 3)], ddl)
    new = spark.createDataFrame([(D(2024, 1, 5), "a", 20), (D(2024, 1, 7), "c", 30), (D(2024, 1, 1), "a", 10)], ddl)
    once = overwrite_window(old, new, "d", D(2024, 1, 5), ["d", "k"])
    assert rows(once) == [(D(2024, 1, 1), "a", 10), (D(2024, 1, 5), "a", 20), (D(2024, 1, 7), "c", 30)]
    assert rows(overwrite_window(once, new, "d", D(2024, 1, 5), ["d", "k"])) == rows(once)


def test_reprocess_window_and_backfill(spark):
    today = D(2024, 6, 1)
    assert reprocess_window(None, today) == (D(2020, 1, 1), today)
    assert reprocess_window(D(2024, 5, 30), today) == (D(2024, 5, 1), today)
    days = [(D(2024, 1, d),) for d in range(1, 11)]
    df = spark.createDataFrame(days, "d date")
    got = backfill(df.withColumn("s", F.lit("archive")), df.withColumn("s", F.lit("live")), "d", D(2024, 1, 8))
    assert [(r.d.day, r.s) for r in got.orderBy("d").collect()] == [
        (d, "archive") for d in range(1, 6)] + [(d, "live") for d in (6, 7, 8)]


def test_new_or_changed(spark):
    ddl = "k int, v string, at int"
    old = spark.createDataFrame([(1, "a", 1), (2, None, 1), (3, "c", 1)], ddl)
    new = spark.createDataFrame([(1, "a", 2), (2, None, 2), (3, "C", 2), (4, "d", 2)], ddl)
    assert rows(new_or_changed(old, new, ["k"], ignore=["at"])) == [(3, "C", 2), (4, "d", 2)]
    assert new_or_changed(old, new, ["k"]).count() == 4
    nothing = spark.createDataFrame([(None, "x", 1)], ddl)
    assert new_or_changed(nothing, nothing, ["k"]).count() == 0


def test_take_until_marker(spark):
    df = spark.createDataFrame([(D(2024, 1, d), d, f"u{d}") for d in range(1, 8)] + [(None, 0, "u0")],
                               "d date, n int, url string")
    assert rows(take_until_marker(df, ["d", "n"], "url", "u5").select("n")) == [(6,), (7,)]
    assert take_until_marker(df, ["d", "n"], "url", "absent").count() == 8
    assert take_until_marker(df, ["d", "n"], "url", "u7").count() == 0
    assert rows(take_until_marker(df, ["n"], "url", "u2", descending=False).select("n")) == [(0,), (1,)]
    assert newest(df, ["d", "n"]).first().url == "u7"
    assert df.select(high_water(df, "n").alias("x")).first().x == 7


# ---- keys and statistics

def test_dense_key_is_one_to_n_on_a_hot_value(spark):
    rnd = random.Random(7)
    data = [("hot" if rnd.random() < 0.4 else f"v{rnd.randrange(50)}", i) for i in range(2000)]
    df = spark.createDataFrame(data, "v string, i int").repartition(6)
    keyed = dense_key(df, ["v", "i"], "key")
    got = {r.key: (r.v, r.i) for r in keyed.collect()}
    assert got == {n + 1: pair for n, pair in enumerate(sorted(data))}
    assert dict(keyed.dtypes)["key"] == "bigint"


def test_dense_key_never_uses_one_task_for_the_rows(spark):
    df = spark.range(1000).withColumn("v", F.rand(3))
    keyed = dense_key(df, ["v", "id"], "key")
    # the only single-partition exchange orders one row per partition
    text = plan(keyed)
    before = text.split("SinglePartition")[1] if "SinglePartition" in text else ""
    assert "HashAggregate" in before


def test_dense_key_spreads_copies(spark):
    """A third of the rows are copies of one row; they still get keys of their own."""
    df = spark.createDataFrame([("copy" if i % 3 == 0 else f"v{i:04d}",) for i in range(900)], "v string").repartition(4)
    keyed = dense_key(df, ["v"], "key", ties=True)
    assert keyed.columns == ["key", "v"]
    got = sorted(map(tuple, keyed.collect()))
    assert [k for k, _ in got] == list(range(1, 901))
    assert [v for _, v in got] == sorted(v for _, v in got)


def test_dense_key_of_nothing(spark):
    assert dense_key(spark.range(0), ["id"], "key").count() == 0


def test_global_stats_without_a_single_partition(spark):
    df = spark.range(100).select("id", (F.col("id") % 7).alias("x"))
    got = with_global_stats(df, ["x"])
    assert got.where("min_x = 0 and max_x = 6").count() == 100
    assert "Window" not in plan(got) and "SinglePartition" in plan(df.agg(F.max("x")))


def test_minmax_variants(spark):
    df = spark.createDataFrame([(1, 0.0, 5.0), (2, 10.0, 5.0), (3, None, 5.0)], "i int, a double, c double")
    kept = minmax_scale(df, {"s": "a", "t": "c"}).orderBy("i").select("s", "t").collect()
    assert [tuple(r) for r in kept] == [(0.0, None), (100.0, None), (None, None)]
    zero = minmax_scale(df, {"s": "a", "inv": "a", "t": "c"}, scale=1, null_to=0, invert=["inv"])
    assert [tuple(r) for r in zero.orderBy("i").select("s", "inv", "t").collect()] == [
        (0.0, 1.0, 0.0), (1.0, 0.0, 0.0), (0.0, 1.0, 0.0)]


def test_scenarios(spark):
    df = spark.createDataFrame([("m", 50.0, 90.0, 80.0)], "id string, idx double, a double, b double")
    got = scenarios(df, {"Base": {}, "Up": {"a": 1.5}}, {"a": 0.5, "b": 0.5}, "idx", ["id"])
    assert rows(got) == [("m", "Base", 50.0, 90.0, 80.0), ("m", "Up", 107.5, 135.0, 80.0)]


# ---- shape

def test_unpivot_and_pivot_are_inverse(spark):
    data = [(D(2024, 1, d), k, d * i) for d in (1, 2, 3) for i, k in enumerate("abc") if (d, k) != (2, "b")]
    long = spark.createDataFrame(data, "d date, k string, v int")
    wide = pivot_last(long, "d", "k", "v", ["a", "b", "c"], ["d"])
    assert rows(unpivot_long(wide, ["d"], ["a", "b", "c"], "k", "v")) == rows(long)
    assert unpivot_long(wide, ["d"], ["a", "b", "c"], "k", "v", drop_null=False).count() == 9


def test_pivot_takes_the_last_value_that_is_not_null(spark):
    df = spark.createDataFrame([(1, "a", 5, 1), (1, "a", 7, 2), (1, "a", None, 3)], "d int, k string, v int, o int")
    assert rows(pivot_last(df, "d", "k", "v", ["a"], ["o"])) == [(1, 7)]


def test_outer_join_all(spark):
    a = spark.createDataFrame([(1, 10, 1), (2, 20, 2)], "d int, anchor int, x int")
    b = spark.createDataFrame([(2, 99, 5), (3, 99, 6)], "d int, anchor int, y int")
    c = spark.createDataFrame([(3, 99, 7), (4, 99, 8)], "d int, anchor int, x int")
    joined = outer_join_all([a, b, c], "d", "anchor")
    assert joined.columns == ["d", "anchor", "x", "y"]
    assert rows(joined) == [(1, 10, 1, None), (2, 20, 2, 5), (3, None, None, 6), (4, None, None, None)]
    assert plan(joined).count("Exchange hashpartitioning") == 1


def test_days_and_months_of_intervals(spark):
    data = [(1, D(2024, 1, 30), D(2024, 3, 2)), (2, D(2024, 1, 5), None), (3, D(2024, 1, 5), D(2024, 1, 1)),
            (4, None, D(2024, 1, 1)), (5, D(2024, 2, 29), D(2024, 2, 29))]
    df = spark.createDataFrame(data, "i int, s date, e date")
    days = explode_days(df, "s", "e", "d")
    assert {r.i: r["count"] for r in days.groupBy("i").count().collect()} == {1: 33, 2: 1, 5: 1}
    by_day = days.groupBy(F.trunc("d", "month").alias("m")).agg(F.count("*").alias("n"))
    by_month = explode_months(df, "s", "e").groupBy(F.col("month_start").alias("m")).agg(F.sum("days").alias("n"))
    assert rows(by_day) == rows(by_month)


def test_zip_arrays(spark):
    df = spark.createDataFrame([(1, ["a", "b"], [1.0, None]), (2, [], [])], "i int, t array<string>, v array<double>")
    got = zip_arrays_to_rows(df, {"day": F.col("t"), "x": F.col("v")}, {"source": "s"}, keep=["i"])
    assert rows(got) == [(1, "a", 1.0, "s"), (1, "b", None, "s")]
    bad = spark.createDataFrame([(["a"], [1.0, 2.0])], "t array<string>, v array<double>")
    with pytest.raises(Exception, match="differ in length"):
        zip_arrays_to_rows(bad, {"day": F.col("t"), "x": F.col("v")}).collect()


def test_unique_columns(spark):
    df = spark.range(1).select(F.lit(1).alias("a"), F.lit(2).alias("b"), F.lit(3).alias("a"))
    assert rows(unique_columns(df)) == [(1, 2)]


# ---- aggregates and sets

def test_rollup_class_counts_and_sets(spark):
    df = spark.createDataFrame([("d1", "dom", 1), ("d1", "int", 2), ("d2", "other", 3), ("d1", "dom", 4)],
                               "d string, c string, v int")
    assert rows(class_counts(df, "d", "c", ["dom", "int"])) == [("d1", 2, 1, 3)]
    assert rows(rollup_spec(df, ["d"], {"s": ("sum", "v"), "m": ("max", "v"), "a": ("avg", "v")})) == [
        ("d1", 7, 4, 7 / 3), ("d2", 3, 3, 3.0)]
    one, two = df.select("d"), spark.createDataFrame([("d3",), (None,)], "d string")
    assert rows(union_distinct([one, two])) == [("d1",), ("d2",), ("d3",), (None,)]
    assert rows(distinct_values(two, "d")) == [("d3",)]
    assert union_all([one, two.withColumn("z", F.lit(1))], allow_missing=True).count() == 6
    assert rows(project(df, {"x": "v", "y": "d"}).limit(1)) == [(1, "d1")]
    assert with_lineage(df, "s", "sys").columns[-3:] == ["source", "source_system", "crawl_time"]
    assert require_text(spark.createDataFrame([("",), (None,), ("u",)], "u string"), "u").count() == 1


def test_lookup_keeps_all_rows(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    dim = spark.createDataFrame([("a", 1, "no")], "k string, key int, other string")
    assert rows(lookup_dim(df, dim, ["k"], "key")) == [("a", 1), ("b", None), (None, None)]


def test_quality(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 3), (None, 4), ("b", 4), ("a", 5)], "k string, v int")
    report = check(df, [unique("k"), not_null("k"), not_null("v"), unique("v")])
    assert rows(report) == [("not_null", "k", 2), ("not_null", "v", 1), ("unique", "k", 1), ("unique", "v", 1)]
    assert missing_columns(df, ["k", "z"]) == ["z"]


# ---- records and scoring

def test_json_records(spark):
    text = [
        '[{"Title": "t", "PublisherId": 7, "Headlines": null}, {"Title": "u", "Extra": 1}]',
        '{"Title": "bare"}', "not json", "[]", None, '  [{"Title": "v"}]', "[1, 2]",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(text)], "i int, body string")
    got = explode_json_records(df, "body", ARTICLE_OBJECT, keep=["i"]).select("i", "Title", "Headlines", "PublisherId")
    good = [r for r in rows(got) if r[0] != 6]
    assert good == [(0, "t", "", "7"), (0, "u", "", ""), (5, "v", "", "")]


EPOCH_PAGE = """<html><body><article class="other"><h3 class="title-news"><a href="no">no</a></h3></article>
<article class="item-news  item-news-common thumb" data-publishtime="1704067200">
<p class="thumb-art"><a href="x"><img src="i"></a></p>
<h3 class="title-news big"><a href="https://h/1"> Đà <b>Nẵng</b> &amp; Huế </a></h3>
<p class="description"><a href="z">First <i>line</i><br>second</a> tail</p></article>
<article class="item-news item-news-common"><h3 class="title-news"></h3></article></body></html>"""
ISO_PAGE = """<div class="box-category-item"><a class="box-category-link-title" href="/p" title="Full title">Cut</a>
<a class="box-category-sapo">By <b>text</b></a><div class="box-time" title="2024-05-01T01:02:03">ago</div></div>
<div class="box-category-item"><a class="box-category-link-title" href="/q">From<span> text</span></a>"""


def test_listings(spark):
    pages = spark.createDataFrame([(1, EPOCH_PAGE), (2, None), (3, "<article")], "page_id int, html string")
    got = extract_records(pages, LISTING_EPOCH, keep=["page_id"]).orderBy("pos").collect()
    assert [tuple(r) for r in got] == [
        (1, 0, "ĐàNẵng& Huế", "https://h/1", "First line second", "1704067200"), (1, 1, "", "", "", "")]
    iso = extract_records(spark.createDataFrame([(1, ISO_PAGE)], "page_id int, html string"), LISTING_ISO,
                          keep=["page_id"]).orderBy("pos").collect()
    assert [tuple(r) for r in iso] == [
        (1, 0, "Full title", "/p", "By text", "2024-05-01T01:02:03"), (1, 1, "Fromtext", "/q", "", "")]


def _fails_on(word):
    def load():
        def scorer(texts):
            if any(word in t for t in texts):
                raise RuntimeError("model failed")
            return ["POS"] * len(texts)
        return scorer
    return load


def test_scoring(spark):
    texts = ["good good bad", "bad, <b>very</b> bad", "plain", "", None, "GOOD!"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    factory = word_list_scorer(["good"], ["bad"])
    scored = score_text(df, "s", factory).orderBy("i").select("score", "label").collect()
    assert [tuple(r) for r in scored] == [
        (1, "Tích cực"), (-1, "Tiêu cực"), (0, "Trung lập"), (0, "Trung lập"), (0, "Trung lập"), (1, "Tích cực")]
    native = df.select("i", word_list_label(F.col("s"), ["good"], ["bad"]).alias("p"))
    assert native.orderBy("i").select("p.score", "p.label").collect() == scored
    assert [r[0] for r in df.where("i >= 3").select(model_input(F.col("s"))).collect()] == ["trống", "trống", "GOOD"]


def test_scoring_failure_is_neutral_and_counted(spark):
    df = spark.createDataFrame([(i, "boom" if i == 0 else "ok") for i in range(40)], "i int, s string").coalesce(1)
    seen = Observation(f"failed-{uuid.uuid4().hex}")
    scored = score_text(df, "s", _fails_on("boom"), batch_size=8, observation=seen)
    labels = [r.label for r in scored.collect()]
    failed = seen.get["failed"]
    assert failed == labels.count("Trung lập") and 1 <= failed <= 8
