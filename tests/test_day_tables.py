"""Day tables refreshed in place against the refresh of a whole table."""

import datetime as dt
import random

import pytest

from lakesteps.operators import overwrite_window, pivot_last
from lakesteps.sources import patch_wide, read_days, refresh_days, stored_days

DDL = "day date, k string, v int"
D = lambda n: dt.date(2024, 1, n)
KEYS = ["day", "k"]


def rows(df):
    return sorted(map(tuple, df.select("day", "k", "v").collect()), key=str)


def files(path):
    return {p.name: sorted(q.name for q in p.glob("*.parquet")) for p in path.glob("day=*")}


def made(rnd, n):
    days = rnd.sample(range(1, 29), 8)
    return [(None if rnd.random() < 0.05 else D(rnd.choice(days)), rnd.choice("abc"), rnd.randrange(99)) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_the_refresh_of_the_whole_table(spark, tmp_path, seed):
    rnd, path, whole = random.Random(seed), tmp_path / "t", spark.createDataFrame([], DDL)
    wide = str(tmp_path / "wide")
    for step in range(4):
        new = spark.createDataFrame(made(rnd, rnd.choice([0, 5, 40])), DDL)
        start = D(rnd.randint(1, 28))
        want = rows(overwrite_window(whole, new, "day", start, KEYS))
        whole = spark.createDataFrame(want, DDL)
        before = files(path)
        touched = refresh_days(new, str(path), "day", start, KEYS)
        if path.exists():
            assert rows(read_days(spark, str(path), new.schema)) == want
            after, names = files(path), {f"day={d.isoformat() if d else '__HIVE_DEFAULT_PARTITION__'}" for d in touched}
            assert {n for n in before.keys() | after.keys() if before.get(n) != after.get(n)} <= names
            assert all(d is None or d >= start or any(r[0] == d for r in new.collect()) for d in touched)
        schema = patch_wide(spark, str(path), new.schema, wide, touched, "day", "k", "v", ["a", "b", "c"])
        if want:
            got = sorted(map(tuple, read_days(spark, wide, schema).collect()), key=str)
            assert got == sorted(map(tuple, pivot_last(whole, "day", "k", "v", ["a", "b", "c"], ["day"]).collect()), key=str)


def test_days_that_become_empty_lose_their_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    refresh_days(spark.createDataFrame([(D(1), "a", 1), (D(2), "a", 2), (None, "a", 3)], DDL), path, "day", D(1), KEYS)
    assert stored_days(spark, path, "day") == [None, D(1), D(2)]
    touched = refresh_days(spark.createDataFrame([(D(3), "a", 4)], DDL), path, "day", D(2), KEYS)
    assert touched == [None, D(2), D(3)] and stored_days(spark, path, "day") == [D(1), D(3)]


def test_only_the_days_asked_for_are_read(spark, tmp_path):
    path = tmp_path / "t"
    schema = spark.createDataFrame([], DDL).schema
    refresh_days(spark.createDataFrame([(D(n), "a", n) for n in range(1, 6)], DDL), str(path), "day", D(1), KEYS)
    for part in (path / "day=2024-01-01").glob("*.parquet"):
        part.write_bytes(b"broken")
        part.with_name(f".{part.name}.crc").unlink()
    assert rows(read_days(spark, str(path), schema, [D(4)], "day")) == [(D(4), "a", 4)]
    # an early correction reads its own day; a window reads none
    refresh_days(spark.createDataFrame([(D(2), "b", 7), (D(5), "a", 8)], DDL), str(path), "day", D(5), KEYS)
    assert rows(read_days(spark, str(path), schema, [D(2), D(5)], "day")) == [(D(2), "a", 2), (D(2), "b", 7), (D(5), "a", 8)]
