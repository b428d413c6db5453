"""Terms from a table in texts, against a comparison of every pair."""

import random
from collections import Counter

import numpy as np
import pytest

from lakesteps.operators import terms as T


def pairs(spark, texts, terms, **how):
    got = T.term_matches(spark.createDataFrame(texts, "id int, body string"),
                         spark.createDataFrame(terms, "no int, word string"), "id", "body", "no", "word", **how)
    return Counter(map(tuple, got.collect()))


def brute(texts, terms, form=str.lower):
    return Counter((i, n) for i, t in texts for n, w in terms if t is not None and w and form(w) in form(t))


@pytest.mark.parametrize("seed", range(2))
def test_equals_all_pairs(spark, seed):
    rnd = random.Random(seed)
    alphabet = ["a", "b", "B", "é", "🙂", " ", "\n"] if seed % 2 else list("abcdefghijklmnopqrstuvwxyz ")
    text = lambda n: "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, n)))
    texts = [(i, text(120)) for i in range(150)] + [(7, None), (7, "abab"), (7, "abab"), (None, "bab")]
    some = [t for _, t in texts if t]
    terms = [(i, text(rnd.choice([1, 2, 3, 4, 9, 14]))) for i in range(60)] + [(900, None), (901, ""), (902, "ab"), (903, "AB")]
    terms += [(1000 + i, t[k:k + rnd.choice([1, 2, 5, 8, 9, 30])]) for i, t in enumerate(some[:50]) for k in [len(t) // 3]]
    assert pairs(spark, texts, terms) == brute(texts, terms)
    assert pairs(spark, texts, terms, ignore_case=False) == brute(texts, terms, str)


def test_a_term_is_filed_under_its_rarest_gram(spark):
    """The opening of every text is common; terms that share it with one text meet that text only."""
    texts = [(i, f"the same opening and then number {i:04d}") for i in range(300)]
    terms = [(1, "the same opening and then number 0123"), (2, "the same opening and then number 9999"), (3, "opening")]
    assert pairs(spark, texts, terms) == brute(texts, terms)


def test_hot_grams_are_dealt_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(T, "ROWS_PER_GRAM", 20)
    texts = [(i, "x" * (i % 5) + "hot word") for i in range(400)]
    terms = [(1, "hot word"), (2, "o"), (3, "xx"), (4, "hot wordy")]
    monkeypatch.setattr(T, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert pairs(spark, texts, terms) == brute(texts, terms)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_terms_and_no_texts(spark):
    assert pairs(spark, [(1, "a")], []) == Counter() == pairs(spark, [(1, "a")], [(1, ""), (2, None)])
    assert pairs(spark, [], [(1, "a")]) == Counter() == pairs(spark, [(1, None)], [(1, "a")])


def test_grams_of_batches_of_texts(spark, monkeypatch):
    """Grams come from whole batches, none of them over the end of a text, however the batch is cut."""
    texts = ["", "abcdef", "x", "🙂éabcdefgh", "", "abcabcabcabc"]
    for width, stride in [(1, 1), (3, 1), (5, 4)]:
        code = lambda gram: T._grams([gram], width, 1, None)[1][0]
        want = [(k, code(t[at:at + width])) for k, t in enumerate(texts) for at in range(0, len(t) - width + 1, stride)]
        assert [*zip(*T._grams(texts, width, stride, None))] == want
        assert [*zip(*T._grams(texts, width, stride, np.ones(1 << 22, bool)))] == want
    monkeypatch.setattr(T, "CHARS_AT_ONCE", 7)
    assert [len(p) for p in T._parts(texts)] == [3, 1, 1, 1]
    frame = spark.createDataFrame([(1, "some text")], "__id int, __text string")
    plan = T._coded(frame, "__text", [(3, 3, 1)])._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "regexp_extract_all" not in plan


def test_plan_has_no_nested_loop(spark):
    texts = spark.createDataFrame([(1, "some text")], "id int, body string")
    terms = spark.createDataFrame([(1, "text")], "no int, word string")
    plan = T.term_matches(texts, terms, "id", "body", "no", "word")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
