"""Chat examples: exact round trips, the loss mask, pages and edge rows."""

import hashlib
import random

import pytest
from hypothesis import given, settings, strategies as st

from lakesteps.llm import chat_format as C

SIGNS = ["<", "|", "\\", ">", "\n", "im_end", C.OPEN, C.CLOSE, "<\\|im_end|>", "é🙂", "x", "%", "%0A", "%25", ""]
DDL = "conv_id long, turn long, role string, text string"


@given(st.lists(st.sampled_from(SIGNS), max_size=12).map("".join))
@settings(max_examples=500, deadline=None)
def test_escapes_are_reversible_and_leave_no_mark(text):
    assert C.unescape(C.escape(text)) == text and "<|" not in C.escape(text)
    assert C.unescape_role(C.escape_role(text)) == text and "\n" not in C.escape_role(text)
    assert [*C.turns_of(f"{C.OPEN}{C.escape_role(text)}\n{C.escape(text)}{C.CLOSE}\n" * 2)] == [(text, text)] * 2


def made(seed, n=40):
    rnd = random.Random(seed)
    text = lambda k: "".join(rnd.choice(SIGNS) for _ in range(rnd.randint(0, k)))
    rows = []
    for conv in range(n):
        turns = rnd.choice([1, 2, 3, 8, 80, 170]) if conv else 300
        rows += [(conv, i, rnd.choice(["user", "assistant", "assistant", "system", "odd\nrole<|", None]),
                  None if rnd.random() < 0.1 else text(9) if rnd.random() < 0.97 else "long <| text" * 9000)
                 for i in range(turns)]
    rnd.shuffle(rows)
    return rows


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    rows = made(request.param)
    talks = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: r[:2]):
        talks.setdefault(conv, []).append((role or "", text or ""))
    return spark.createDataFrame(rows, DDL).repartition(5), talks


def test_each_reply_has_an_example_with_all_before_it(case):
    turns, talks = case
    examples = C.training_examples(turns).cache()
    got = {}
    for r in C.whole_text(examples).orderBy("conv_id", "row").collect():
        got.setdefault(r["conv_id"], []).append(r)
    for conv, talk in talks.items():
        replies = [i for i, (role, _) in enumerate(talk) if role == C.REPLY]
        assert len(got.get(conv, [])) == len(replies)
        for i, r in zip(replies, got.get(conv, [])):
            assert [*C.turns_of(r["text"])] == talk[:i + 1]
            assert C.unescape(r["text"][r["loss_start"]:r["loss_end"]]) == talk[i][1]
            assert r["text"][r["loss_end"]:] == C.CLOSE + "\n"
    assert examples.where("kind = 'page'").count() > 5
    longest = examples.selectExpr("max(length(text))").first()[0]
    assert longest < C.PAGE_CHARS + 3 * 110_000  # a page closes with the turn that fills it, an example adds one


@pytest.mark.parametrize("in_order", [True, False])
def test_read_back(case, in_order):
    turns, talks = case
    examples = C.training_examples(turns)
    got = {r["conv_id"]: r for r in C.read_back(examples if in_order else examples.repartition(7), in_order).collect()}
    assert set(got) == set(talks)
    for conv, talk in talks.items():
        loss = "".join(t for role, t in talk if role == C.REPLY)
        all_turns = "".join(f"{role}\n{t}\n" for role, t in talk)
        r = got[conv]
        assert (r["n_turns"], r["loss_chars"], r["n_examples"]) == (len(talk), len(loss), sum(role == C.REPLY for role, _ in talk))
        assert r["turns_sha256"] == hashlib.sha256(all_turns.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_rows_grow_with_the_turns(spark):
    """A conversation four times as long takes four times the rows and about four times the text."""
    sizes = []
    for n in (400, 1600):
        rows = [(1, i, "assistant" if i % 2 else "user", "some words") for i in range(n)]
        sizes.append(C.training_examples(spark.createDataFrame(rows, DDL)).selectExpr(
            "count(*)", "sum(length(text))").first())
    assert sizes[1][0] < 4.1 * sizes[0][0] and sizes[1][1] < 4.5 * sizes[0][1]


def test_edge_rows(spark):
    ddl = DDL + ", row int, kind string, new_from string, conv int"
    rows = [(None, 1, "user", "a", 1, "k", "n", 1), (None, None, "assistant", None, 1, "k", "n", 1),
            (1, 0, None, None, None, None, None, None), (2, 0, "assistant", "x" * 300_000, 1, "k", "n", 1),
            (3, 0, "user", "tie", 1, "k", "n", 1), (3, 0, "assistant", "tie", 1, "k", "n", 1), (3, 0, "user", "tie", 1, "k", "n", 1)]
    turns = spark.createDataFrame(rows, ddl)
    got = {r["conv_id"]: (r["n_turns"], r["loss_chars"], r["n_examples"]) for r in C.read_back(C.training_examples(turns)).collect()}
    assert got == {None: (2, 0, 1), 1: (1, 0, 0), 2: (1, 300_000, 1), 3: (3, 3, 1)}
    kinds = sorted((r["conv_id"], r["kind"]) for r in C.training_examples(turns).where("conv_id = 3").collect())
    assert kinds == [(3, "example"), (3, "rest")]
    assert C.training_examples(turns.limit(0)).collect() == [] and C.read_back(C.training_examples(turns.limit(0))).collect() == []
