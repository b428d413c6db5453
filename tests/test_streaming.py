"""Streaming jobs give what the batch operators give."""

import datetime as dt

from pyspark.sql import functions as F, types as T

from lakesteps.operators import keep_last
from lakesteps.streaming import (
    latest_per_batch, merge_batch, read_stream, stream_append, stream_daily_counts, stream_dedup, stream_merge,
    write_stream,
)

DDL = "day date, k string, v int, o int"
D = dt.date


def rows(df):
    """Sorted rows; a table partitioned by day lists that column last."""
    names = [c for c in ("day", "k", "v", "o") if c in df.columns] or df.columns
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def run(query):
    query.awaitTermination()


def test_append_reads_each_file_once(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    (src / "1.csv").write_text("a,b\n1,x\n")
    args = (spark, str(src), schema, str(tmp_path / "out"), str(tmp_path / "cp"))
    run(stream_append(*args))
    (src / "2.csv").write_text("a,b\n2,y\n")
    run(stream_append(*args))
    run(stream_append(*args))
    assert rows(spark.read.schema(schema).parquet(str(tmp_path / "out"))) == [(1, "x"), (2, "y")]


def test_merge_takes_corrections_and_late_rows_of_any_age(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = spark.createDataFrame([], DDL).schema

    def feed(data):
        spark.createDataFrame(data, DDL).coalesce(1).write.mode("append").parquet(src)
        run(stream_merge(read_stream(spark, src, schema, "parquet"), out, str(tmp_path / "cp"), "day",
                         ["day", "k"], ["o"]))
        return rows(spark.read.schema(schema).parquet(out))

    feed([(D(2024, 1, 1), "a", 1, 1), (D(2024, 2, 15), "a", 2, 1), (D(2024, 2, 15), "a", 3, 2)])
    got = feed([(D(2024, 2, 15), "a", 4, 3), (D(2024, 1, 17), "b", 5, 1), (D(2024, 1, 16), "c", 6, 1),
                (D(2024, 2, 15), "z", 7, 1)])
    assert got == [(D(2024, 1, 1), "a", 1, 1), (D(2024, 1, 16), "c", 6, 1), (D(2024, 1, 17), "b", 5, 1),
                   (D(2024, 2, 15), "a", 4, 3), (D(2024, 2, 15), "z", 7, 1)]
    # a correction may be smaller in the ordinal; rows without a date stay, in every batch
    feed([(None, "n", 1, 1), (D(2024, 2, 15), "a", 8, 0), (D(2024, 2, 15), "a", 9, -1)])
    got = feed([(None, "m", 2, 1), (None, "n", 3, 0), (D(2045, 1, 1), "f", 1, 1)])
    assert (D(2024, 2, 15), "a", 8, 0) in got and (D(2045, 1, 1), "f", 1, 1) in got
    assert [r for r in got if r[0] is None] == [(None, "m", 2, 1), (None, "n", 3, 0)]


def test_merge_after_a_checkpoint_reset_takes_the_new_rows(spark, tmp_path):
    out, schema = str(tmp_path / "out"), spark.createDataFrame([], DDL).schema
    for n in (1, 2):
        src = str(tmp_path / f"in{n}")
        spark.createDataFrame([(D(2024, 1, n), "a", n, n)], DDL).write.parquet(src)
        cp = tmp_path / "cp"
        run(stream_merge(read_stream(spark, src, schema, "parquet"), out, str(cp), "day", ["day", "k"], ["o"]))
        assert (cp / "staged").exists()
        cp.rename(tmp_path / f"gone{n}")  # the checkpoint folder is reset
    assert rows(spark.read.schema(schema).parquet(out)) == [(D(2024, 1, 1), "a", 1, 1), (D(2024, 1, 2), "a", 2, 2)]


def test_merge_batch_can_be_repeated(spark, tmp_path):
    out = str(tmp_path / "out")
    merge = merge_batch(out, "day", ["day", "k"], ["o"], str(tmp_path / "staged"))
    first = spark.createDataFrame([(D(2024, 1, 1), "a", 1, 1)], DDL)
    second = spark.createDataFrame([(D(2024, 1, 1), "a", 2, 2), (D(2024, 1, 2), "b", 3, 1)], DDL)
    merge(first, 0)
    merge(second, 1)
    once = rows(spark.read.schema(first.schema).parquet(out))
    # the batch fails after its merge was staged and half of the table is lost
    spark.read.schema(first.schema).parquet(out).limit(0).write.mode("overwrite").partitionBy("day").parquet(out)
    merge(second, 1)
    assert rows(spark.read.schema(first.schema).parquet(out)) == once == [
        (D(2024, 1, 1), "a", 2, 2), (D(2024, 1, 2), "b", 3, 1)]


def test_dedup_and_daily_counts(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts", "user_id", "event_type")
    src = str(tmp_path / "in")
    events.repartition(3).write.parquet(src)
    stream = read_stream(spark, src, events.schema, "parquet", maxFilesPerTrigger=1)
    run(write_stream(stream_dedup(stream, "ts", "60 days", ["user_id"]).select("user_id"), str(tmp_path / "d"), str(tmp_path / "dcp")))
    assert rows(spark.read.schema("user_id bigint").parquet(str(tmp_path / "d"))) == rows(events.select("user_id").distinct())

    counts = stream_daily_counts(stream, "ts", "event_type", "60 days")
    run(stream_merge(counts, str(tmp_path / "c"), str(tmp_path / "ccp"), "day", ["day", "event_type"], ["n"], output_mode="update"))
    got = spark.read.schema("day date, event_type string, n bigint").parquet(str(tmp_path / "c"))
    want = events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"))
    names = ["day", "event_type", "n"]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(map(tuple, want.select(*names).collect()))


def test_hot_keys_are_thinned_before_the_shuffle(spark):
    data = [(i, None if i % 5 == 0 else "hot" if i % 3 else f"k{i}", (1 << 60) + i,
             None if i % 4 == 0 else dt.datetime(2024, 1, 1) + dt.timedelta(hours=i * 37 % 600)) for i in range(600)]
    df = spark.createDataFrame(data, "i int, k string, big bigint, ts timestamp").coalesce(1)
    got = sorted(map(tuple, latest_per_batch(df, ["k"], "ts").collect()))
    best = {}
    for row in data:
        kept = best.get(row[1])
        if kept is None or row[3] is not None and (kept[3] is None or row[3] > kept[3]):
            best[row[1]] = row
    assert got == sorted(best.values())


def test_dedup_keeps_a_key_whose_late_row_comes_before_a_timely_one(spark, tmp_path):
    ddl, src = "ts timestamp, k string", str(tmp_path / "in")
    day = lambda n: dt.datetime(2050, 1, n)
    for part in ([(day(20), "x")], [(day(21), "w")], [(day(1), "late then timely"), (day(22), "late then timely")]):
        spark.createDataFrame(part, ddl).coalesce(1).write.mode("append").parquet(src)
    stream = read_stream(spark, src, spark.createDataFrame([], ddl).schema, "parquet", maxFilesPerTrigger=1)
    run(write_stream(stream_dedup(stream, "ts", "1 day", ["k"]).select("k"), str(tmp_path / "o"), str(tmp_path / "c")))
    assert rows(spark.read.schema("k string").parquet(str(tmp_path / "o"))) == [("late then timely",), ("w",), ("x",)]


def test_keep_last_over_an_appended_table(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), "a", 1, 1), (D(2024, 1, 1), "a", 2, 2)], DDL)
    assert rows(keep_last(df, ["day", "k"], ["o"])) == [(D(2024, 1, 1), "a", 2, 2)]
