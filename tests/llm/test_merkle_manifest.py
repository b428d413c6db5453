"""Merkle manifests against a plain tree, the closed form against the order of completion."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lakesteps.llm import merkle_manifest as M
from lakesteps.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
DDL = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """The root, and per node its siblings and place, level by level."""
    proofs, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 3] for i in range(0, len(nodes), 3)]
        for k, at in enumerate(where):
            run = runs[at // 3]
            proofs[k].append((run[:at % 3], run[at % 3 + 1:]))
            where[k] = at // 3
        nodes = [sha("".join(r)) for r in runs]
    return nodes[0], proofs


def climb(digest, proof):
    for left, right in proof:
        digest = sha("".join([*left, digest, *right]))
    return digest


def expected(docs, tampered=False):
    """{doc_id: [(leaf, subroot, root, proof digest, folded root)]} of rows (doc_id, text, lang, source, n_chars)."""
    docs = [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), d)) for d in docs]
    groups = {}
    for d in docs:
        groups.setdefault(d["source"], []).append(d)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for s in order:
        rows = sorted(groups[s], key=lambda d: (d["doc_id"] is not None, d["doc_id"] or 0, leaf([d[f] for f in FIELDS])))
        built[s] = (rows, *tree([leaf([d[f] for f in FIELDS]) for d in rows]))
    root, over = tree([built[s][1] for s in order])
    out = {}
    for s, above in zip(order, over):
        rows, sub, proofs = built[s]
        for d, proof in zip(rows, proofs):
            proof = proof + above
            changed = dict(d)
            if tampered and d["text"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 2 == 0:
                changed["text"] = d["text"].replace("\n", "")
            folded = climb(leaf([changed[f] for f in FIELDS]), proof)
            out.setdefault(d["doc_id"], []).append((
                leaf([d[f] for f in FIELDS]), sub, root,
                sha("".join("".join(left + right) for left, right in proof)), folded))
    return out


def shown(rows):
    return rows.select(
        "id", "digest", "subroot", "root", F.sha2(M.siblings(F.col("proof")), 256),
        M.fold(F.col("digest"), F.col("proof")))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 26, 27, 28, 81, 82, 100, 243, 700])
def test_closed_form_is_the_order_of_completion(n):
    leaves = [sha(str(i)).encode() for i in range(n)]
    levels = M.levels_of(n)
    log = M.segment_of(leaves, levels)
    nodes, places = [x.decode() for x in leaves], set()
    for h in range(levels + 1):
        for x, digest in enumerate(nodes):
            at = M.log_position(h, x, n)
            assert log[at].decode() == digest
            places.add(at)
        nodes = [sha("".join(nodes[i:i + 3])) for i in range(0, len(nodes), 3)]
    assert places == set(range(len(log)))


def test_blocks_make_the_same_log_and_proofs(spark):
    """Blocks of 9 leaves: three rounds, partial blocks, one hot group, a tree of one leaf."""
    rnd = random.Random(7)
    docs = [(i, f"text {i}", None, rnd.choice(["hot"] * 6 + ["b", "é", None, "", "z"]), i) for i in range(230)]
    docs += [(1000, "lone", "en", "one", 4)] + [(2000 + i, "x", "l", f"s{i}", 1) for i in range(20)]
    made = M.build_manifest(spark.createDataFrame(docs, DDL).repartition(4), FIELDS, depth=2)
    assert len(made.log) == 3 and len(made.upper) == 2
    want = expected(docs)
    got = {r[0]: [tuple(r)[1:]] for r in shown(M.with_proofs(made)).collect()}
    assert got == want
    trees = {r["tree"]: r for r in made.trees.collect()}
    nodes = {}
    for r in made.nodes().collect():
        nodes.setdefault(r["tree"], {})[r["position"]] = r
    for number, t in trees.items():
        log = nodes[number]
        assert sorted(log) == list(range(len(log))) and log[len(log) - 1]["digest"] == t["root"]
        for r in log.values():
            assert r["position"] == M.log_position(r["level"], r["index"], t["n"])


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet")
            .select("doc_id", "text", "lang", "source", "n_chars").collect()]
    want = expected(docs, tampered=True)
    got = {r["doc_id"]: r for r in QUERIES["op13_merkle_manifest"](spark, SF_DIR).collect()}
    assert set(got) == set(want)
    failed = 0
    for doc_id, ((digest, sub, root, proof, folded),) in want.items():
        r = got[doc_id]
        assert (r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"]) == (digest, sub, root, proof, folded)
        assert r["verified"] == (folded == root)
        failed += folded != root
    assert 0 < failed < len(docs)


def test_edge_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "", "s", 0), (None, "no id", "en", "s", 1), (3, "long " * 200_000, "en", "s", 1),
            (4, "same", "en", "s", 4), (4, "same", "en", "s", 4), (4, "unlike", "en", "s", 4), (5, "1:a", "-", "", None)]
    ddl = DDL + ", tree string, number int, digest string, proof int, `block` int, id int"
    docs = spark.createDataFrame([(*r, "t", 1, "d", 2, 3, 4) for r in rows], ddl)
    want = expected(rows)
    got = {}
    for r in shown(M.with_proofs(M.build_manifest(docs, FIELDS))).collect():
        got.setdefault(r[0], []).append(tuple(r)[1:])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    none = M.build_manifest(docs.limit(0), FIELDS)
    assert none.root() is None and M.with_proofs(none).collect() == [] and none.nodes().collect() == []


def test_repeated_rows_in_one_group(spark):
    rows = [(7, "copy", "en", "s", 4)] * 50
    got = [tuple(r)[1:] for r in shown(M.with_proofs(M.build_manifest(spark.createDataFrame(rows, DDL), FIELDS))).collect()]
    assert sorted(got) == sorted(expected(rows)[7])
