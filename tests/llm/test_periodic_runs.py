"""Periodic runs against a search over all periods, by itself and in the query."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from lakesteps.llm.periodic_runs import WaveletTree, basic_factors, periodic_runs, runs_of_texts
from lakesteps.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0D]+")


def all_runs(words, least=12):
    """Every run, by trying every period at every place."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def fibonacci(n):
    x, y = ["a"], ["a", "b"]
    while len(y) < n:
        x, y = y, y + x
    return y[:n]


def made(rnd):
    words = [rnd.choice("abcdefgh"[:rnd.choice([1, 2, 2, 3, 8])]) for _ in range(rnd.choice([0, 1, 11, 12, 13, 30, 90, 200]))]
    if words and rnd.random() < 0.6:
        p, a = rnd.randint(1, max(1, len(words) // 2)), rnd.randrange(len(words))
        for i in range(a, rnd.randint(a, len(words))):
            words[i] = words[a + (i - a) % p]
    return words * rnd.choice([1, 1, 2, 3])


def check(texts):
    runs, counts, repeated = runs_of_texts(texts)
    at = place = 0
    for words, n in zip(texts, counts):
        want = all_runs(words)
        assert [tuple(map(int, r)) for r in runs[at:at + n]] == want
        gone = {i for s, l, q in want for i in range(s + q, s + l)}
        assert [bool(x) for x in repeated[place:place + len(words) + 1]] == [i in gone for i in range(len(words) + 1)]
        at, place = at + n, place + len(words) + 1
    assert at == len(runs)


@pytest.mark.parametrize("seed", range(40))
def test_runs_of_made_texts(seed):
    rnd = random.Random(seed)
    check([made(rnd) for _ in range(rnd.randint(1, 12))])


@given(st.lists(st.lists(st.sampled_from("ab"), max_size=60), min_size=1, max_size=4))
@settings(max_examples=150, deadline=None)
def test_runs_of_any_texts(texts):
    check(texts)


def test_runs_within_runs():
    period = ["a"] * 20 + ["b"]
    check([fibonacci(300), ["a"] * 100, period * 3, list("abababa") * 2, ["b", *"abababaabababa", "b"], [], ["x"]])


def test_wavelet_tree():
    rnd = np.random.default_rng(3)
    values = rnd.permutation(1000)
    tree = WaveletTree(values.astype(np.int32), 1000)
    lo = rnd.integers(0, 1000, 400)
    hi = np.minimum(1000, lo + rnd.integers(1, 300, 400))
    v = rnd.integers(0, 3000, 400)
    assert list(tree.below(lo, hi, v)) == [int((values[a:b] < x).sum()) for a, b, x in zip(lo, hi, v)]
    rank = (rnd.random(400) * (hi - lo)).astype(np.int64)
    assert list(tree.smallest(lo, hi, rank)) == [sorted(values[a:b])[k] for a, b, k in zip(lo, hi, rank)]


def test_basic_factors_are_classes_of_equal_stretches():
    rnd = random.Random(4)
    codes = np.array([rnd.randrange(3) for _ in range(120)] + [9])
    ranks, suffixes = basic_factors(codes, 5)
    assert sorted(suffixes) == list(range(121))
    for k, rank in enumerate(ranks):
        stretch = [tuple(codes[i:i + 2 ** k]) for i in range(121)]
        assert len(set(zip(stretch, rank))) == len(set(stretch)) == len(set(rank))
        for i in range(121):
            members = {int(s) for s in suffixes[rank[i]:rank[i] + list(rank).count(rank[i])]}
            assert members == {j for j in range(121) if stretch[j] == stretch[i]}


def test_query_equals_all_periods(spark):
    """Documents of up to 3,000 words; the longer ones only in the runs that were planted."""
    docs = {r[0]: r[1] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op11_periodic_runs"](spark, SF_DIR).collect()}
    assert set(got) == set(docs)
    seen = 0
    for doc_id, text in docs.items():
        words = WORD.findall(text or "")
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        if len(words) > 3000:
            continue
        runs = all_runs(words)
        row = got[doc_id]
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        assert row["n_runs"] == len(runs)
        assert (row["start"], row["length"], row["period"]) == best
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
        seen += bool(runs)
    assert seen > 5


def test_edge_rows(spark):
    ddl = "doc_id long, text string, runs int, collapsed string, id int, n_words string"
    rows = [(1, None, 1, "c", 1, "n"), (2, "", None, None, None, None), (None, "la " * 15, 1, "c", 1, "n"),
            (3, "a\x85b c " * 70_000, 1, "c", 1, "n"), (4, "same\x0btext", 1, "c", 1, "n"), (4, "same\x0btext", 1, "c", 1, "n")]
    docs = spark.createDataFrame(rows, ddl)
    got = sorted(map(tuple, periodic_runs(docs).collect()), key=str)
    assert got == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (None, 15, [(0, 15, 1)], "la"), (3, 70_000, [(0, 70_000, 1)], "a\x85b c"),
        (4, 2, [], "same text"), (4, 2, [], "same text")], key=str)
    assert periodic_runs(docs.limit(0)).collect() == []
