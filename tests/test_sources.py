"""Readers, writers, marks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from lakesteps import schemas
from lakesteps.session import materialize, shared_dir
from lakesteps.sources import (
    append, export_csv, load_mark, path_exists, read_delimited, read_inferred_csv, read_partition,
    read_typed_csv, replace, save_mark, union_feeds, write_sorted,
)


def write(path, text, bom=False):
    path.write_bytes((b"\xef\xbb\xbf" if bom else b"") + text.encode("utf-8"))
    return str(path)


def test_semicolon_file_with_bom_and_empty_fields(spark, tmp_path):
    path = write(tmp_path / "s.csv", "year;month;period_type;accommodation_guests;accommodation_intl_guests;"
                 "accommodation_domestic_guests;tourism_revenue_billion_vnd\n2019;;annual;8;3;5;30973\n2025;2;monthly;7;;4;\n", bom=True)
    df = read_delimited(spark, path, schemas.STATISTICS, sep=";")
    assert [tuple(r) for r in df.collect()] == [(2019, None, "annual", 8, 3, 5, 30973.0), (2025, 2, "monthly", 7, None, 4, None)]


def test_quoted_commas(spark, tmp_path):
    path = write(tmp_path / "e.csv", 'event_name,start_date,end_date,location,category\n'
                 '"A, B ""C""",2021-05,2021-05,"Road, district",Sport\n', bom=True)
    assert tuple(read_delimited(spark, path, schemas.EVENT).first()) == ('A, B "C"', "2021-05", "2021-05", "Road, district", "Sport")


def test_typed_csv_binds_by_name(spark, tmp_path):
    path = write(tmp_path / "t.csv", "extra,b,a,d\nx,2,1,2024-01-01\ny,,3,soon\n", bom=True)
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType()),
                           T.StructField("d", T.DateType()), T.StructField("absent", T.StringType())])
    got = read_typed_csv(spark, path, schema, date_cols=["d"])
    assert [tuple(r) for r in got.collect()] == [(1, 2.0, dt.date(2024, 1, 1), None), (3, None, None, None)]
    assert read_typed_csv(spark, path, schema, strict=False).collect() == got.collect()
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_typed_csv(spark, path, schema).collect()
    with pytest.raises(ValueError, match="extra"):
        read_typed_csv(spark, path, schema, ignore_unknown=False)
    assert dict(read_inferred_csv(spark, path).dtypes)["a"] == "int"


def test_union_feeds_reports_rejects(spark, tmp_path):
    paths = [write(tmp_path / "1.csv", "a,b,c\n1,2,3\n", bom=True), str(tmp_path / "none.csv"),
             write(tmp_path / "2.csv", "a\n9\n"), write(tmp_path / "3.csv", "a,b\n"), write(tmp_path / "4.csv", "b,a\n5,4\n6,7\n")]
    df, rejected = union_feeds(spark, paths, ["a", "b"])
    assert rejected == [(paths[2], ["b"])]
    got = df.orderBy("_feed", "_line").select("a", "b", "c").collect()
    assert [tuple(r) for r in got] == [("1", "2", "3"), ("4", "5", None), ("7", "6", None)]
    assert union_feeds(spark, [str(tmp_path / "none.csv")], ["a"]) == (None, [])


def test_append_replace_and_partition(spark, tmp_path):
    path = str(tmp_path / "table")
    df = spark.range(3).withColumn("ds", F.lit("2024-01-01").cast("date"))
    append(df, path, ["ds"])
    append(df.withColumn("ds", F.lit("2024-01-02").cast("date")), path, ["ds"])
    part = read_partition(spark, path, dt.date(2024, 1, 2))
    assert part.count() == 3
    assert "PartitionFilters: [isnotnull(ds" in part._jdf.queryExecution().executedPlan().toString()
    stored = spark.read.parquet(path)
    replace(stored.where("id > 0"), path, ["ds"])
    assert spark.read.parquet(path).count() == 4
    assert sorted(p.name for p in tmp_path.iterdir()) == ["table"]


def test_csv_export_round_trip(spark, tmp_path):
    df = spark.createDataFrame([('a "q", b', 1), ("Đà Nẵng", None)], "s string, n bigint")
    export_csv(df, str(tmp_path / "c"))
    back = read_typed_csv(spark, str(tmp_path / "c"), df.schema)
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)


def test_sorted_write(spark, tmp_path):
    write_sorted(spark.range(1000).withColumn("v", F.rand(1)), str(tmp_path / "s"), "v")
    files = spark.read.parquet(str(tmp_path / "s")).groupBy(F.input_file_name().alias("f")).agg(
        F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("f").collect()
    assert all(a.hi <= b.lo for a, b in zip(files, files[1:]))


def test_marks(spark, tmp_path):
    path, ddl = str(tmp_path / "mark"), "last_date string, total bigint"
    assert load_mark(spark, path, ddl) is None
    one = spark.createDataFrame([("2024-01-01", 5)], ddl)
    save_mark(one, path)
    save_mark(one.limit(0), path)
    assert tuple(load_mark(spark, path, ddl)) == ("2024-01-01", 5)
    save_mark(spark.createDataFrame([("2023-06-01", 9)], ddl), path)
    assert tuple(load_mark(spark, path, ddl)) == ("2023-06-01", 9)


def test_feeds_keep_line_breaks_and_file_order(spark, tmp_path):
    folder = tmp_path / "f"
    folder.mkdir()
    write(folder / "a.csv", 'k,v\n1,"first\nline"\n')
    write(folder / "b.csv", "k,v\n" + "".join(f"{i},later{'x' * 50}\n" for i in range(1, 400)))
    df, _ = union_feeds(spark, [str(folder)], ["k"])
    from lakesteps.operators import keep_first
    kept = keep_first(df, ["k"], ["_feed", "_line"]).where("k = 1").select("v").collect()
    assert [r[0] for r in kept] == ["first\nline"]
    back = spark.createDataFrame([(1, 'a\n"b",\r\nc')], "n bigint, s string")
    export_csv(back, str(tmp_path / "e"))
    assert [tuple(r) for r in read_typed_csv(spark, str(tmp_path / "e"), back.schema).collect()] == [(1, 'a\n"b",\r\nc')]


def test_a_file_with_its_columns_in_another_order_is_an_error(spark, tmp_path):
    folder = tmp_path / "g"
    folder.mkdir()
    write(folder / "a.csv", "a,b\n1,2\n")
    write(folder / "b.csv", "b,a\n2,1\n")
    schema = T.StructType.fromDDL("a string, b string")
    with pytest.raises(Exception, match="(?i)header"):
        read_typed_csv(spark, str(folder), schema).collect()


def test_a_mark_has_one_row(spark, tmp_path):
    with pytest.raises(ValueError, match="one row"):
        save_mark(spark.range(2), str(tmp_path / "m"))


def test_materialize_uses_the_named_folder(spark):
    before = shared_dir(spark)
    df = materialize(spark.range(10), "probe")
    assert df.count() == 10 and before.removeprefix("file:") in df.inputFiles()[0]
    assert path_exists(spark, before)
