"""Operators over groups of rows against brute force, and the pipeline as a whole."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakesteps.llm import arc_warc, exact_dedup, mixing, order_minhash
from lakesteps.llm.components import components
from lakesteps.llm.queries import QUERIES
from lakesteps.session import materialize

SF_DIR = "/root/testdata/sf0.001"
DDL = "doc_id long, text string, lang string, source string, n_chars long, digest string, kept int, node int"
EDGE = [
    (1, None, None, None, None, "d", 1, 1), (2, "", "en", "s", 0, None, None, None), (3, "same text", "en", "s", 9, "d", 1, 1),
    (5, "same text", "en", "t", 9, "d", 1, 1), (5, "same text", "en", "t", 9, "d", 1, 1), (None, "same text", "en", "t", 9, "d", 1, 1),
    (None, "alone", "en", "t", 5, "d", 1, 1), (7, "word " * 30_000, "en", "s", 1, "d", 1, 1), (8, "?!", "en", "s", 2, "d", 1, 1),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DDL)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---- exact copies

def test_exact_duplicates_edges(spark, edge):
    got = {r.doc_id: tuple(r)[1:4] for r in exact_dedup.exact_duplicates(edge).where("doc_id is not null").collect()}
    assert got == {1: (2, 2, False), 2: (2, 2, True), 3: (5, 4, False), 5: (5, 4, True), 7: (7, 1, True), 8: (8, 1, True)}
    nulls = rows(exact_dedup.exact_duplicates(edge).where("doc_id is null").select("keep_id", "group_size", "kept"))
    assert nulls == [(5, 4, False), (None, 1, True)]
    kept = exact_dedup.keep_one_copy(edge)
    assert kept.columns == edge.columns
    assert rows(kept.select("doc_id", "source")) == sorted([(2, "s"), (5, "t"), (None, "t"), (7, "s"), (8, "s")], key=str)
    assert exact_dedup.exact_duplicates(edge.limit(0)).collect() == [] == exact_dedup.keep_one_copy(edge.limit(0)).collect()


def test_unlike_texts_of_one_digest_stay_apart(spark):
    rnd = random.Random(1)
    data = [(i, f"text {rnd.randrange(60)}") for i in range(600)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(7)
    weak = lambda text: F.substring(F.sha2(text, 256), 1, 1)  # noqa: E731  16 values for 60 texts
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(df, digest=weak, salts=3).collect()}
    for i, text in data:
        group = [j for j, t in data if t == text]
        assert got[i] == (max(group), len(group), i == max(group))


# ---- components

def test_components_against_union_find(spark):
    rnd = random.Random(2)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5000 + i) for i in range(1, 60)]
    parent = {n: n for e in links for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.comp for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: find(n) for e in links if e[0] != e[1] for n in e}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# ---- near copies

def brute_share(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
    return table[-1, -1] / max(len(a), len(b), 1)


def test_alignment_against_the_full_table():
    rnd = random.Random(3)
    for _ in range(300):
        a = [rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 40))]
        b = [w for w in a if rnd.random() > 0.1]
        for _ in range(rnd.randint(0, 6)):
            b.insert(rnd.randint(0, len(b)), rnd.choice("abcxyz"))
        share = brute_share(a, b)
        assert order_minhash.aligned_share(a, b) == pytest.approx(share if share >= 0.8 - 1e-12 and a else 0)
        assert order_minhash.aligns(a, b) == (bool(a) and share >= 0.8 - 1e-12)


def test_sketches_follow_order_and_occurrence():
    rnd = random.Random(4)
    words = [f"w{rnd.randrange(500)}" for _ in range(300)]
    shared = lambda x, y: len(set(order_minhash.sketch(" ".join(x))) & set(order_minhash.sketch(" ".join(y))))
    edited = [w if rnd.random() > 0.02 else "new" for w in words]
    assert shared(words, words) == order_minhash.SKETCHES
    assert shared(words, edited) > 10
    halves = words[150:] + words[:150]  # the same shingles in another order share fewer sketches
    assert shared(words, halves) < shared(words, edited)
    assert shared(["a"] * 40, ["a"] * 400) < order_minhash.SKETCHES  # one shingle, told apart by number
    assert order_minhash.sketch("") == [] == order_minhash.sketch("?! ...") and len(order_minhash.sketch("one")) == order_minhash.SKETCHES


def test_near_duplicates_against_brute_force(spark):
    """Planted copies of some texts, a crowd that shares a passage, and texts of their own."""
    rnd = random.Random(5)
    word = lambda: f"w{rnd.randrange(3000)}"
    passage, texts = [word() for _ in range(60)], []
    for g in range(12):
        # long enough that an edit leaves most five-word shingles: what the sketches are made for
        base = [word() for _ in range(rnd.choice([60, 120, 200]))]
        texts.append(base)
        for _ in range(g):
            texts.append([w if rnd.random() > 0.02 else word() for w in base])
    for _ in range(60):  # unlike texts around one passage
        texts.append([word() for _ in range(rnd.randint(20, 60))] + passage + [word() for _ in range(rnd.randint(0, 40))])
    data = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(900 + i, " ".join(texts[i])) for i in range(20)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    parent = {i: i for i, _ in data}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    split = {i: t.split() for i, t in data}
    for i, a in split.items():
        for j, b in split.items():
            if i < j and find(i) != find(j) and order_minhash.aligned_share(a, b):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    want = {i: find(i) for i, _ in data}
    for how in ({}, {"crowd": 20}):  # with a low limit the finer sketches take over
        got = {r.doc_id: (r.class_id, r.kept) for r in order_minhash.near_duplicates(df, **how).collect()}
        assert all(want[i] == want[c] for i, (c, _) in got.items())  # nothing is joined wrongly
        assert {i: c for i, (c, _) in got.items()} == want
        assert all(kept == (c == i) for i, (c, kept) in got.items())


def test_rare_words_leave_out_no_pair_that_aligns():
    rnd = random.Random(8)
    counts = np.zeros(order_minhash.BUCKETS, np.int32)
    aligned = 0
    for _ in range(1500):
        a = [f"w{rnd.randrange(30)}" for _ in range(rnd.randint(1, 60))]
        b = [w if rnd.random() > 0.12 else f"w{rnd.randrange(30)}" for w in a if rnd.random() > 0.06]
        counts[order_minhash._buckets(a)] = rnd.randrange(9)
        if order_minhash.aligned_share(a, b):
            aligned += 1
            (x, s), (y, t) = (order_minhash.rare_words(w, counts, 0.8) for w in (a, b))
            assert set(x) & set(y)
            apart = sum(((p ^ q) & (2**64 - 1)).bit_count() for p, q in zip(s, t))
            assert apart <= len(a) + len(b) - 1.6 * max(len(a), len(b)) + 1e-9
    assert aligned > 300


def test_crowds_find_what_direct_comparison_finds(spark):
    """Short texts with edits, where many sketch values span classes: the limit changes nothing."""
    rnd = random.Random(9)
    word = lambda: f"w{rnd.randrange(500)}"
    passage, texts = [word() for _ in range(12)], []
    for _ in range(60):
        base = passage + [word() for _ in range(8)]
        texts.append(base)
        for _ in range(2):
            edited = list(texts[-1])
            edited[rnd.randrange(13, 20)] = word()
            edited[rnd.randrange(0, 3)] = word()
            texts.append(edited)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    whole = rows(order_minhash.near_duplicates(df, crowd=10**12))
    assert len({r[1] for r in whole}) < 120
    assert rows(order_minhash.near_duplicates(df, crowd=0)) == whole


def test_pairs_of_a_crowd_that_cannot_align_never_become_rows(spark, monkeypatch):
    """Unlike texts around one passage: they share words, too few to align, and all sketch values of it."""
    rnd = random.Random(4)
    passage = [f"p{i}" for i in range(570)]
    texts = [passage + [f"w{rnd.randrange(2000)}" for _ in range(215)] for _ in range(60)]
    texts += [[*t[:-3], "x", "y", "z"] for t in texts[:2]] + [passage + texts[0][600:] + texts[5][570:600]]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    compared, verify = [], order_minhash._verify
    monkeypatch.setattr(order_minhash, "_verify", lambda pairs, *a: (compared.append(rows(pairs)), verify(pairs, *a))[1])
    got = {r[0]: r[1] for r in rows(order_minhash.near_duplicates(df, crowd=0))}
    assert got == {i: i for i in range(60)} | {60: 0, 61: 1, 62: 0}
    stars, across = compared
    assert len(across) == len(set(across)) < len(texts)


@pytest.mark.parametrize("block", [1, 7, 10**6])
def test_blocks_of_a_crowd_give_each_pair_once(spark, monkeypatch, block):
    """The pairs are those of the direct join, less some whose words differ too much, however texts are dealt."""
    monkeypatch.setattr(order_minhash, "BLOCK", block)
    rnd = random.Random(8)
    texts = {i: [f"w{rnd.randrange(40)}" for _ in range(rnd.randint(20, 26))] for i in range(40)}
    for i in range(40, 60):
        texts[i] = [w if rnd.random() > 0.1 else "new" for w in texts[i - 40]]
    bodies = spark.createDataFrame([(i, len(t), " ".join(t)) for i, t in texts.items()], "node long, n long, text string")
    members = spark.createDataFrame([(i, len(texts[i]), k) for i in texts for k in range(4) if (i % 20) % (k + 1) == 0], "node long, n long, key long")
    spots = order_minhash._open_spots(members, spark.createDataFrame([(i, i % 3) for i in range(9)], "node long, comp long"))
    direct = rows(order_minhash._across(spots, 0.8).distinct())
    got = rows(order_minhash._across_crowds(spots, bodies, 0.8))
    assert len(got) == len(set(got)) and set(got) <= set(direct)
    assert {(a, b) for a, b in direct if order_minhash.aligns(texts[a], texts[b])} <= set(got)
    assert 10 < len(got) < len(direct)


def test_near_duplicates_edges(spark, edge):
    got = order_minhash.near_duplicates(edge)
    assert rows(got.where("doc_id is not null")) == [(1, 1, True), (2, 1, False), (3, 3, True), (5, 3, False), (5, 3, False), (7, 7, True), (8, 8, True)]
    assert rows(got.where("doc_id is null")) == [(None, 3, False), (None, None, True)]
    kept = order_minhash.keep_one_of_class(edge)
    assert kept.columns == edge.columns and rows(kept.select("doc_id")) == sorted([(1,), (3,), (7,), (8,), (None,)], key=str)
    assert order_minhash.near_duplicates(edge.limit(0)).collect() == []


# ---- mixing

def brute_rake(cells, goals, sweeps=200):
    """Proportional fitting of a full table in numpy."""
    axes = [sorted({c[k] for c in cells}) for k in range(3)]
    table = np.zeros([len(a) for a in axes])
    for c, v in cells.items():
        table[tuple(a.index(x) for a, x in zip(axes, c))] = v
    total = table.sum()
    for _ in range(sweeps):
        for k, goal in enumerate(goals):
            sums = table.sum(axis=tuple(j for j in range(3) if j != k), keepdims=True)
            want = np.array([goal[x] for x in axes[k]]).reshape([-1 if j == k else 1 for j in range(3)])
            table = table * (want * total / sums)
    return {c: table[tuple(a.index(x) for a, x in zip(axes, c))] for c in cells}


def test_mixing_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plan = mixing.sampling_plan(docs).collect()
    cells = {(r.source, r.lang, r.topic): r.tokens for r in plan}
    goals = []
    for k, dim in enumerate(mixing.DIMENSIONS):
        sums = {}
        for c, v in cells.items():
            sums[c[k]] = sums.get(c[k], 0) + v
        power = {x: v ** mixing.TEMPER[dim] for x, v in sums.items()}
        goals.append({x: v / sum(power.values()) for x, v in power.items()})
    want = brute_rake(cells, goals)
    for r in plan:
        assert r.fitted == pytest.approx(want[r.source, r.lang, r.topic], rel=2e-3, abs=1e-6)
    drawn = sum(r.tokens * r.probability for r in plan)
    assert drawn == pytest.approx(mixing.RATE * sum(cells.values()), rel=1e-3)
    scale = {round(r.probability * r.tokens / r.fitted, 4) for r in plan if r.tokens and r.probability < 1}
    assert max(scale) - min(scale) < 1e-2
    got = mixing.mix_documents(docs).collect()
    assert len(got) == docs.count()
    share = sum(r.n_tokens for r in got if r.selected) / sum(cells.values())
    assert abs(share - mixing.RATE) < 0.08
    again = mixing.mix_documents(docs.repartition(3))
    assert {r.doc_id for r in again.where("selected").collect()} == {r.doc_id for r in got if r.selected}
    assert {r.doc_id for r in mixing.sample_to_targets(docs).collect()} == {r.doc_id for r in got if r.selected}


def brute_draw(cells, goals, sweeps=500):
    """Bounded raking of {cell: (tokens, expected)} by plain loops."""
    now = {c: min(t, e) for c, (t, e) in cells.items()}
    for _ in range(sweeps):
        for k, goal in enumerate(goals):
            for value, aim in goal.items():
                mine = [c for c in cells if c[k] == value]
                full = [c for c in mine if now[c] >= cells[c][0]]
                total, shut = sum(now[c] for c in mine), sum(now[c] for c in full)
                for c in mine:
                    if aim < total:
                        now[c] *= aim / total
                    elif c not in full:
                        now[c] = min(cells[c][0], now[c] * (aim - shut) / (total - shut))
    return now


def test_draws_meet_reachable_targets_after_clipping(spark):
    """Cells that give all they have; a value that cannot reach its target; the others' shares hold."""
    tokens = {("a", "x", "p"): 900, ("a", "y", "p"): 700, ("b", "x", "p"): 500, ("b", "y", "q"): 60,
              ("a", "x", "q"): 40, ("b", "x", "q"): 50, ("a", "y", "q"): 80, ("b", "y", "p"): 400}
    frame = spark.createDataFrame([(*c, t) for c, t in tokens.items()], "source string, lang string, topic string, tokens long")
    share = lambda d: spark.createDataFrame(list(d.items()), "value string, share double")
    targets = {"source": share({"a": .5, "b": .5}), "lang": share({"x": .5, "y": .5}), "topic": share({"p": .8, "q": .2})}
    fitted = mixing.rake(frame, targets)
    plan = materialize(mixing.draw_rates(fitted, 0.6))
    got = {(r.source, r.lang, r.topic): r for r in plan.collect()}
    budget = 0.6 * sum(tokens.values())
    goals = [{"a": budget / 2, "b": budget / 2}, {"x": budget / 2, "y": budget / 2}, {"p": budget - 230, "q": 230}]
    want = brute_draw({c: (r.tokens, r.fitted * 0.6) for c, r in got.items()}, goals)
    for c, r in got.items():
        assert r.tokens * r.probability == pytest.approx(want[c], rel=2e-3)
        assert 0 <= r.probability <= 1
    report = {(r.dimension, r.value): r for r in mixing.mixing_report(plan, rate=0.6).collect()}
    assert report["topic", "q"].target == pytest.approx(0.2, rel=1e-3)
    assert report["topic", "q"].reachable == pytest.approx(230 / budget, rel=1e-3)
    for r in report.values():
        assert r.expected == pytest.approx(r.reachable, rel=2e-3)


def test_goals_that_exclude_each_other_are_warned_of(spark):
    cells = spark.createDataFrame([("a", "x", "p", 100, 10.0), ("a", "y", "p", 10, 50.0), ("b", "x", "p", 10, 50.0),
                                   ("b", "y", "p", 100, 10.0)], "source string, lang string, topic string, tokens long, fitted double")
    lone = cells.where("not (source = 'b' and lang = 'y')")
    with pytest.warns(UserWarning, match="reachable"):
        plan = mixing.draw_rates(lone.withColumn("fitted", F.expr("if(source = 'b', 90D, 15D)")), 0.9, sweeps=3)
    assert plan.agg(F.sum(F.col("tokens") * F.col("probability"))).first()[0] == pytest.approx(108, rel=1e-3)


def test_sweeps_are_written_in_plans_of_one_join(spark, monkeypatch):
    """The driver keeps plans; one over all dimensions of a sweep holds the first step eight times."""
    written = []
    monkeypatch.setattr(mixing, "materialize", lambda df, label="step": (
        written.append((label, df._jdf.queryExecution().optimizedPlan().toString().count("Join "))), materialize(df, label))[1])
    cells = spark.createDataFrame([("a", "x", "p", 90), ("a", "y", "q", 70), ("b", "x", "q", 50), ("b", "y", "p", 6)],
                                  "source string, lang string, topic string, tokens long")
    share = spark.createDataFrame([("a", .5), ("b", .5), ("x", .5), ("y", .5), ("p", .5), ("q", .5)], "value string, share double")
    mixing.draw_rates(mixing.rake(cells, {d: share for d in mixing.DIMENSIONS}, sweeps=2), sweeps=2)
    for label in ("rake", "draw"):
        joins = [n for k, n in written if k == label]
        assert len(joins) >= 2 and max(joins) <= 3


def test_drawn_shares_of_documents(spark):
    """Expected shares are the reachable ones, drawn shares lie near them."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plan = materialize(mixing.sampling_plan(docs))
    for r in mixing.mixing_report(plan, mixing.mix_documents(docs)).collect():
        assert r.expected == pytest.approx(r.reachable, rel=0.01), r
        assert abs(r.drawn - r.expected) < 0.05, r


def test_mixing_stated_targets_and_edges(spark, edge):
    lang = spark.createDataFrame([("en", 0.9), ("absent", 5.0), ("", 0.1)], "value string, share double")
    got = mixing.mix_documents(edge, targets={"lang": lang}, rate=1.0)
    assert got.count() == len(EDGE) and set(got.columns) == {"doc_id", "source", "lang", "topic", "n_tokens", "probability", "selected"}
    assert got.where("not probability between 0 and 1").count() == 0
    assert mixing.sample_to_targets(edge).columns == edge.columns
    assert mixing.mix_documents(edge.limit(0)).collect() == [] == mixing.sample_to_targets(edge.limit(0)).collect()


# ---- archives

PAGES = [(1, "http://a/ b\tc", "x" * 1500, 1), (2, None, "x" * 1500, 1), (3, "u", None, 1), (4, "u", "", 1), (5, "u", "small é", 1),
         (6, "u", "small é", 1), (7, "u", "WARC/1.1\r\n\r\nfake\nhttp://x 0.0.0.0 20240101000000 text/html 5\n" * 30, 1), (8, "u", "x" * 1500, 1),
         (None, "u", "x" * 1500, 1), (9, "u", "é" * 700, 1), (9, "u", "é" * 700, 1)]


@pytest.mark.parametrize("version", [1, 2])
def test_archives_give_back_what_was_written(spark, tmp_path, version, monkeypatch):
    monkeypatch.setattr(arc_warc, "FILE_RECORDS", 3)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, digest int").repartition(2)
    arc_warc.write_arc(pages, str(tmp_path / "arc"), version)
    back = arc_warc.read_arc(spark, str(tmp_path / "arc"))
    assert rows(back.select("page_id", "payload")) == sorted([(i, h or "") for i, _, h, _ in PAGES], key=str)
    got = arc_warc.archive_round_trip(pages, version=version)
    want = []
    for i, _, h, _ in PAGES:
        body = (h or "").encode()
        same = [j for j, _, g, _ in PAGES if (g or "") == (h or "") and j is not None]
        other = max(same) if len(body) >= 1000 and i is not None and max(same) > i else None
        want.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if other else "response", other))
    assert rows(got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) == sorted(want, key=str)
    assert set(r[0][:10] for r in got.select("record_id").collect()) == {"<urn:uuid:"}
    assert {r[0] for r in got.select("warc_date").collect()} == {"2024-01-01T00:00:00Z"}
    assert arc_warc.archive_round_trip(pages.limit(0)).collect() == []


def test_bad_archives_are_errors():
    head = b"filedesc://x 0.0.0.0 20240101000000 text/plain 9\n1 0 Org\n\n\n"
    good = b"http://a b 1.2.3.4 20240101000000 text/html 3\nabc\n"
    assert [(r["url"], r["content"]) for r in arc_warc.arc_records(head + good * 2)] == [("http://a b", b"abc")] * 2
    for bad in (head + good[:-3], head + b"no header here\n", head.replace(b"1 0 Org", b"7 0 Org") + good):
        with pytest.raises(ValueError):
            list(arc_warc.arc_records(bad))
    with pytest.raises(ValueError):
        list(arc_warc.warc_records(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"))


# ---- the whole

def test_pipeline_stages_against_their_operators(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "minhash_near_dedup", "mixing", "bpe"]
    kept, frames = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        frames[name] = materialize(stage(spark, kept, SF_DIR), "test-stage")
        if name != "bpe":
            assert frames[name].columns == docs.columns
        kept = frames[name]
    before = dict(zip(frames, [docs, *frames.values()]))
    clean = {r.doc_id: r.text for r in frames["quality_rules"].collect()}
    good = {r.doc_id for r in QUERIES["op10_line_quality"](spark, SF_DIR).where("kept").collect()}
    assert set(clean) == good and all(r.n_chars == len(r.text) for r in frames["quality_rules"].collect())
    largest = {}
    for i, text in clean.items():
        largest[text] = max(i, largest.get(text, i))
    assert {r.doc_id for r in frames["exact_dedup"].collect()} == set(largest.values())
    for a in frames["minhash_near_dedup"].collect():
        assert clean[a.doc_id] == a.text
    words = {r.doc_id: order_minhash.words_of(r.text) for r in before["minhash_near_dedup"].collect()}
    stay = {r.doc_id for r in frames["minhash_near_dedup"].collect()}
    gone = set(words) - stay
    assert gone and all(any(order_minhash.aligns(words[i], words[j]) for j in words if j != i) for i in gone)
    assert {r.doc_id for r in frames["mixing"].collect()} <= stay
    assert {r.doc_id for r in frames["bpe"].collect()} == {r.doc_id for r in frames["mixing"].collect()}
    assert rows(corpus_pipeline.run(spark, SF_DIR)) == rows(frames["bpe"])
