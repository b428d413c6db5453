"""Streams that remember keys and correct days, against plain Python over the order of arrival."""

import datetime as dt
import random

import pytest

from lakesteps.streaming import (
    count_days, first_seen, read_corrected_days, read_first_seen, read_late, read_stream, stream_first_seen,
)

DDL = "ts timestamp, k string, v int"
T0 = dt.datetime(2024, 3, 1)


def feed(spark, rows):
    return spark.createDataFrame(rows, DDL)


def made(seed, batches=5, n=60):
    rnd = random.Random(seed)
    hour = lambda: T0 + dt.timedelta(hours=rnd.randrange(24 * 12))
    return [[(hour() if rnd.random() > 0.05 else None, rnd.choice(["hot"] * 4 + [None, "", *map(str, range(40))]), b * 1000 + i)
             for i in range(n)] for b in range(batches)]


@pytest.mark.parametrize("seed", [1, 2])
def test_first_seen_over_all_batches(spark, tmp_path, seed):
    root, want, seen = str(tmp_path), [], set()
    low = dt.datetime(1900, 1, 1)
    for b, rows in enumerate(made(seed)):
        batch = feed(spark, rows)
        first_seen(batch, f"x-{b}", root, ["k"], ["ts", "v"], buckets=4, keep=2)
        for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or low, r[2])):
            if r[1] not in seen:
                seen.add(r[1])
                want.append(r)
        if b == 2:  # the batch failed after it had written and comes again
            first_seen(batch, f"x-{b}", root, ["k"], ["ts", "v"], buckets=4, keep=2)
        got = [tuple(r) for r in read_first_seen(spark, root, batch.schema).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert len([p for p in (tmp_path / "seen").iterdir() if p.is_dir()]) <= 4


def test_a_batch_whose_digests_were_not_written_loses_no_row(spark, tmp_path):
    root, batch = str(tmp_path), feed(spark, [(T0, "a", 1)])
    first_seen(batch, "x-0", root, ["k"], ["ts"])
    (tmp_path / "seen" / "batch=x-0").rename(tmp_path / "gone")
    first_seen(batch, "x-0", root, ["k"], ["ts"])
    first_seen(feed(spark, [(T0, "a", 2), (T0, "b", 3)]), "x-1", root, ["k"], ["ts"])
    assert sorted(r["v"] for r in read_first_seen(spark, root, batch.schema).collect()) == [1, 3]


def test_only_touched_buckets_are_read(spark, tmp_path):
    """Other buckets may even be unreadable."""
    root = str(tmp_path)
    first_seen(feed(spark, [(T0, str(i), i) for i in range(200)]), "x-0", root, ["k"], ["ts", "v"], buckets=16)
    first_seen(feed(spark, [(T0, "7", 1)]), "x-1", root, ["k"], ["ts"], buckets=16)
    used = {p.name for p in (tmp_path / "seen" / "batch=x-0").glob("bucket=*")}
    assert len(used) == 16
    from lakesteps.streaming.ledgers import key_digest
    from pyspark.sql import functions as F
    one = feed(spark, [(T0, "7", 1)])
    mine = one.select(F.pmod(F.xxhash64(key_digest(one, ["k"])), F.lit(16))).first()[0]
    for name in used - {f"bucket={mine}"}:
        for part in (tmp_path / "seen" / "batch=x-0" / name).glob("*.parquet"):
            part.write_bytes(b"broken")
            part.with_name(f".{part.name}.crc").unlink()
    first_seen(feed(spark, [(T0, "7", 2)]), "x-2", root, ["k"], ["ts"], buckets=16)
    assert read_first_seen(spark, root, one.schema).count() == 200


def test_a_stream_that_starts_anew_does_not_take_old_batches_for_its_own(spark, tmp_path):
    root = str(tmp_path / "out")
    schema = feed(spark, []).schema
    for n, rows in enumerate([[(T0, "a", 1)], [(T0, "a", 2), (T0, "b", 3)]]):
        feed(spark, rows).write.parquet(str(tmp_path / f"in{n}"))
        stream = read_stream(spark, str(tmp_path / f"in{n}"), schema, "parquet")
        stream_first_seen(stream, root, str(tmp_path / f"cp{n}"), ["k"], ["ts"]).awaitTermination()
    assert sorted(r["v"] for r in read_first_seen(spark, root, schema).collect()) == [1, 3]


@pytest.mark.parametrize("seed", [3, 4])
def test_days_are_corrected_by_late_rows(spark, tmp_path, seed):
    root, rows_so_far, late_so_far, mark = str(tmp_path), [], [], None
    for b, rows in enumerate(made(seed)):
        batch = feed(spark, rows)
        count_days(batch, f"x-{b}", root, "ts", "k", "3 DAYS")
        end = lambda t: dt.datetime(t.year, t.month, t.day) + dt.timedelta(days=1)
        late = [r for r in rows if r[0] is None or mark is not None and end(r[0]) <= mark]
        rows_so_far += rows
        late_so_far += late
        mark = max([mark or T0 - dt.timedelta(99), *(r[0] - dt.timedelta(days=3) for r in rows if r[0])])
        if b == 3:
            count_days(batch, f"x-{b}", root, "ts", "k", "3 DAYS")
        want = {}
        for r in rows_so_far:
            if r[0] is not None:
                n = want.setdefault((r[0].date(), r[1]), [0, 0])
                n[0] += 1
        for r in late_so_far:
            if r[0] is not None:
                want[r[0].date(), r[1]][1] += 1
        got = {(r["day"], r["cls"]): [r["n"], r["n_late"]] for r in read_corrected_days(spark, root).collect()}
        assert got == want
        settled = {k: v for k, v in want.items() if dt.datetime.combine(k[0], dt.time()) + dt.timedelta(days=1) <= mark}
        got = {(r["day"], r["cls"]): [r["n"], r["n_late"]] for r in read_corrected_days(spark, root, open_days=False).collect()}
        assert got == settled
        kept = [tuple(r)[:3] for r in read_late(spark, root, batch.schema).collect()]
        assert sorted(kept, key=str) == sorted(late_so_far, key=str)
    # a late row writes its own day anew and no other
    files = lambda: {p.name: sorted(q.name for q in p.iterdir()) for p in (tmp_path / "settled").glob("day=*")}
    before = files()
    count_days(feed(spark, [(T0 + dt.timedelta(days=1), "late", 1)]), "x-9", root, "ts", "k", "3 DAYS")
    after = files()
    assert {d for d in after if after[d] != before.get(d)} == {"day=2024-03-02"}
