"""CSV read in blocks equals CSV read by one task, wherever the blocks end."""

import random

import pytest
from pyspark.sql import types as T

from lakesteps.sources import export_csv, read_csv_blocks, read_delimited, split_records

SCHEMA = T.StructType().add("i", T.IntegerType()).add("t", T.StringType()).add("x", T.DoubleType())


@pytest.fixture(params=["700", "4k", "1m"])
def blocks(request, spark):
    """Blocks far smaller than the files, as large files have them."""
    keys = {"spark.sql.files.maxPartitionBytes": request.param, "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v)


def same(spark, path, sep=","):
    got = sorted(map(tuple, read_csv_blocks(spark, path, SCHEMA, sep).collect()), key=str)
    assert got == sorted(map(tuple, read_delimited(spark, path, SCHEMA, sep).collect()), key=str)
    return got


def test_random_values(spark, blocks, tmp_path):
    rnd = random.Random(blocks)
    piece = ["a", '"', ",", ";", "\n", "\r\n", '""', "é🙂", " ", "\\", "\n\n"]
    text = lambda: "".join(rnd.choice(piece) for _ in range(rnd.choice([0, 3, 40, 900])))
    rows = [(i, text() if rnd.random() > 0.1 else None, rnd.random()) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    for sep in ",;":
        export_csv(df.coalesce(1), str(tmp_path / f"one{ord(sep)}"), sep)
        assert len(same(spark, str(tmp_path / f"one{ord(sep)}"), sep)) == 300
    export_csv(df.repartition(5), str(tmp_path / "five"))
    same(spark, str(tmp_path / "five"))
    if blocks == "700":
        read = split_records(spark, str(tmp_path / "one44"), header=SCHEMA.names)
        assert read.select("block").distinct().count() > 20


def test_files_as_others_write_them(spark, blocks, tmp_path):
    long = "\n".join(["line"] * 2000)
    for name, body in {
        "crlf": 'i,t,x\r\n1,"a\r\nb",2\r\n3,c,4\r\n', "no last break": 'i,t,x\n1,"a\nb",2\n3,"c"",",4',
        "bom": '﻿i,t,x\n1,é,2\n', "header only": "i,t,x\n", "empty lines": 'i,t,x\n\n1,"\n\n",2\n\n\n3,,\n',
        "one record over many blocks": f'i,t,x\n1,"{long}",2\n3,"{long}{long}",4\n5,e,6\n',
        "quoted header": '"i","t","x"\n1,"q",2\n',
    }.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.csv").write_bytes(body.encode())
        if name != "crlf":
            same(spark, str(tmp_path / name))
    # the reader for one task turns a break inside a value to LF where the file's lines end in CR LF
    got = sorted(map(tuple, read_csv_blocks(spark, str(tmp_path / "crlf"), SCHEMA).collect()))
    assert got == [(1, "a\r\nb", 2.0), (3, "c", 4.0)]


def test_errors(spark, blocks, tmp_path):
    for name, body, said in [("stray", 'i,t,x\n1,5" pipe,2\n3,"a",4\n1,6" pipe,2\n', "unquoted value"),
                             ("header", "i,x,t\n1,2,3\n", "header")]:
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.csv").write_text(body)
        with pytest.raises(Exception, match=said):
            read_csv_blocks(spark, str(tmp_path / name), SCHEMA).collect()
    (tmp_path / "type").mkdir()
    (tmp_path / "type" / "f.csv").write_text("i,t,x\nno number,a,1\n2,b,2\n")
    with pytest.raises(Exception):
        read_csv_blocks(spark, str(tmp_path / "type"), SCHEMA).collect()
    rows = read_csv_blocks(spark, str(tmp_path / "type"), SCHEMA, strict=False).collect()
    assert sorted(map(tuple, rows), key=str) == [(2, "b", 2.0), (None, "a", 1.0)]
