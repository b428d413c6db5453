"""A Merkle manifest of a dataset: one tree per group of rows, one over the groups.

Leaves of a group are put in order of their ids; every FAN consecutive nodes become the digest of
their digests, until one is left. Nodes are kept as a log in the order in which they are completed
(postorder), which needs no pointers. Where a node lies follows from the sizes of complete subtrees:
leaf i comes after i leaves and i // 3 + i // 9 + ... inner nodes, and a node comes as many places
after its last leaf as it has levels.

On Spark the leaves get dense numbers by a range partitioning, and a block of 3^BLOCK_LEVELS
neighbouring leaves, aligned to that size, is one builder's subtree: it writes its nodes as one
segment of the log. The tops of the blocks are the leaves of the next round, a 729th as many. So a
group with most of the rows is built by many tasks, and no group of rows is larger than a block.
Proofs go the other way: each block's siblings are addressed in its segment by the closed form and
put before the proof of its top.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lakesteps.operators import dense_key
from lakesteps.session import materialize

FAN, BLOCK_LEVELS = 3, 6
DIGEST = 32
#: In each level of a proof, where the digest of the level below goes among its siblings.
HERE = "|"
SEGMENTS = "tree long, block long, n long, nodes binary, top string"


def encoded(value: Column) -> Column:
    """A value as text that differs wherever the value does: '-' for null, else its length in bytes."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the levels of its proof lead to."""
    return F.aggregate(proof, leaf, lambda acc, level: F.sha2(F.replace(level, F.lit(HERE), acc), 256))


def siblings(proof: Column) -> Column:
    """All digests of a proof, level by level, left to right."""
    return F.replace(F.array_join(proof, ""), F.lit(HERE), F.lit(""))


def levels_of(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    levels, reach = 0, 1
    while reach < n:
        levels, reach = levels + 1, reach * FAN
    return levels


def log_position(level: int, index: int, n: int, levels: int | None = None) -> int:
    """Place of a node in the log of a tree of n leaves (a block's: of ``levels`` levels)."""
    last = min((index + 1) * FAN ** level, n) - 1
    inner = sum(last // FAN ** h for h in range(1, (levels_of(n) if levels is None else levels) + 1))
    return last + inner + level


def segment_of(leaves: Sequence[bytes], levels: int) -> list[bytes]:
    """The nodes over hex digests in the order of their completion, leaves included."""
    log: list[bytes] = []
    open_runs: list[list[bytes]] = [[] for _ in range(levels + 1)]
    for i, digest in enumerate(leaves):
        log.append(digest)
        open_runs[0].append(digest)
        for h in range(levels):
            if len(open_runs[h]) < FAN and i + 1 < len(leaves):
                break
            digest = hashlib.sha256(b"".join(open_runs[h])).hexdigest().encode()
            log.append(digest)
            open_runs[h] = []
            open_runs[h + 1].append(digest)
    return log


def _shape(n: int, block: int, depth: int) -> tuple[int, int]:
    """(leaves, levels) of a block in a tree with n nodes at the block's lowest level."""
    size = FAN ** depth
    return min(size, n - block * size), depth if n > size else levels_of(n)


def block_proofs(nodes: bytes, n: int, block: int, depth: int) -> tuple[list[str], list[list[str]]]:
    """The lowest digests of a segment and the proof of each, up to the segment's top."""
    leaves, levels = _shape(n, block, depth)

    def node(level: int, index: int) -> str:
        at = log_position(level, index, leaves, levels) * DIGEST
        return nodes[at:at + DIGEST].hex()

    above: list[list[str]] = [[]]
    digests = [node(levels, 0)]
    for h in range(levels - 1, -1, -1):
        count = -(-leaves // FAN ** h)
        digests = [node(h, x) for x in range(count)]
        below = []
        for x in range(count):
            run = x - x % FAN
            level = "".join(HERE if y == x else digests[y] for y in range(run, min(run + FAN, count)))
            below.append([level, *above[x // FAN]])
        above = below
    return digests, above


def grow(nodes: DataFrame, most: int, depth: int = BLOCK_LEVELS) -> list[DataFrame]:
    """Segments of the log, one frame per round, over ``nodes`` (tree, index, n, digest).

    n is the number of leaves of the tree and ``most`` the largest of these.
    """
    size, rounds = FAN ** depth, []

    def build(rows: pa.Table) -> pa.Table:
        tree, block, n = (rows.column(c)[0].as_py() for c in ("tree", "block", "n"))
        by = rows.column("index").to_numpy().argsort()
        leaves = rows.column("digest").take(pa.array(by)).to_pylist()
        log = segment_of([x.encode() for x in leaves], _shape(n, block, depth)[1])
        return pa.table({"tree": [tree], "block": [block], "n": [n],
                         "nodes": pa.array([bytes.fromhex(b"".join(log).decode())], pa.binary()),
                         "top": [log[-1].decode()]})

    while most:
        blocks = nodes.withColumn("block", F.expr(f"`index` div {size}")).select(
            "tree", "block", "n", "index", "digest")
        done = materialize(blocks.groupBy("tree", "block").applyInArrow(build, SEGMENTS), "merkle-log")
        rounds.append(done)
        nodes = done.where(F.col("n") > size).select(
            "tree", F.col("block").alias("index"), F.expr(f"(n + {size} - 1) div {size}").alias("n"),
            F.col("top").alias("digest"))
        most = -(-most // size) if most > size else 0
    return rounds


def tops(rounds: Sequence[DataFrame], depth: int = BLOCK_LEVELS) -> DataFrame:
    """(tree, root) of every tree."""
    whole = [r.where(F.col("n") <= FAN ** depth).select("tree", F.col("top").alias("root")) for r in rounds]
    out = whole[0]
    for r in whole[1:]:
        out = out.unionAll(r)
    return out


@dataclass
class Manifest:
    """What ``build_manifest`` has written.

    leaves: tree, index, n, group, id, digest and the carried columns; trees: tree, group, n, root
    (the group's); log and upper: segments by round of the groups' trees and of the tree over them.
    """

    leaves: DataFrame
    trees: DataFrame
    log: list[DataFrame]
    upper: list[DataFrame]
    depth: int = BLOCK_LEVELS

    def root(self) -> str | None:
        """The digest of the dataset; None for one without rows."""
        row = tops(self.upper, self.depth).first() if self.upper else None
        return row and row["root"]

    def nodes(self) -> DataFrame:
        """The groups' logs node by node: tree, position, level, index, digest."""
        schema = "tree long, position long, level long, index long, digest string"
        out = self.leaves.sparkSession.createDataFrame([], schema)
        total = self.trees.select(F.col("tree").alias("of"), F.col("n").alias("leaves"))
        depth = self.depth

        def listed(s: dict, base: int) -> Iterator[tuple]:
            """Nodes of one segment; the lowest of an upper round are the tops of the round below."""
            m, levels = _shape(s["n"], s["block"], depth)
            for h in range(1 if base else 0, levels + 1):
                first = s["block"] * FAN ** depth // FAN ** h
                for x in range(-(-m // FAN ** h)):
                    at = log_position(h, x, m, levels) * DIGEST
                    yield (s["tree"], log_position(base + h, first + x, s["leaves"]), base + h, first + x,
                           s["nodes"][at:at + DIGEST].hex())

        for r, segments in enumerate(self.log):
            def rows(batches: Iterator[pa.RecordBatch], base=r * depth) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for s in batch.to_pylist():
                        if found := [*listed(s, base)]:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c) for c in zip(*found)],
                                names=["tree", "position", "level", "index", "digest"])

            joined = segments.join(total, F.col("tree") == F.col("of")).drop("of", "top")
            out = out.unionAll(joined.mapInArrow(rows, schema))
        return out


def build_manifest(docs: DataFrame, fields: Sequence[str], id: str = "doc_id", group: str = "source",
                   carry: Mapping[str, Column] | None = None, depth: int = BLOCK_LEVELS) -> Manifest:
    """Build the trees of all rows of ``docs``.

    A leaf is the digest of ``fields``; groups and ids may be null, which go first, and equal ids
    follow their leaf. Groups are ordered by their bytes as text. Repeated rows are leaves of their
    own. ``carry`` adds columns to the leaves, worked out in the same pass over the texts; other
    columns are ignored. A block has 3^``depth`` leaves. An empty table has no trees and no root.
    """
    extra = dict(carry or {})
    rows = docs.select(
        F.col(f"`{group}`").cast("string").alias("group"), F.col(f"`{id}`").alias("id"),
        leaf_digest(*[F.col(f"`{f}`") for f in fields]).alias("digest"), *(c.alias(k) for k, c in extra.items()))
    numbered = materialize(dense_key(rows, ["group", "id", "digest"], "number", ties=True), "merkle-leaves")
    groups = numbered.groupBy("group").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = materialize(dense_key(groups, ["first"], "tree"), "merkle-groups")
    named = groups.select(F.col("group").alias("of"), "first", "n", (F.col("tree") - 1).alias("tree"))
    leaves = numbered.join(named, F.col("group").eqNullSafe(F.col("of"))).select(
        "tree", (F.col("number") - F.col("first")).alias("index"), "n", "group", "id", "digest", *extra)
    most, count = groups.agg(F.max("n"), F.count(F.lit(1))).first()
    log = grow(leaves, most or 0, depth)
    trees = named.select("tree", F.col("of").alias("group"), "n")
    if not log:
        return Manifest(leaves, trees.withColumn("root", F.lit(None).cast("string")), [], [], depth)
    trees = materialize(trees.join(tops(log, depth), "tree"), "merkle-trees")
    upper = grow(trees.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("index"),
                              F.lit(count).cast("long").alias("n"), F.col("root").alias("digest")), count, depth)
    return Manifest(leaves, trees, log, upper, depth)


def _hung(segments: DataFrame, tops: DataFrame) -> DataFrame:
    """The segments with the proofs (tree, index, proof) of their tops."""
    up = tops.select(F.col("tree").alias("of"), F.col("index").alias("at"), "proof")
    return segments.join(up, F.expr("tree = of and block = at")).select("tree", "block", "n", "nodes", "proof")


def _lowest(segments: DataFrame, depth: int) -> DataFrame:
    """(tree, index, digest, proof) of the lowest nodes of segments that have their tops' proofs."""
    size = FAN ** depth

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.to_pylist():
                digests, proofs = block_proofs(s["nodes"], s["n"], s["block"], depth)
                yield pa.RecordBatch.from_arrays([
                    pa.array([s["tree"]] * len(digests), pa.int64()),
                    pa.array(range(s["block"] * size, s["block"] * size + len(digests)), pa.int64()),
                    pa.array(digests), pa.array([[*p, *s["proof"]] for p in proofs], pa.list_(pa.string()))],
                    names=["tree", "index", "digest", "proof"])

    return segments.mapInArrow(rows, "tree long, index long, digest string, proof array<string>")


def _proofs_of_tops(rounds: Sequence[DataFrame], roots: DataFrame, depth: int) -> DataFrame:
    """Proofs (tree, index, proof) of the tops of the first round's segments, from the proofs
    (tree, proof) of the trees' roots, down round by round."""
    known = None
    for segments in reversed(rounds):
        # the root of a tree is the top of one block in one round; other tops lie below it
        whole = segments.where(F.col("n") <= FAN ** depth).select(F.col("tree").alias("t"))
        own = roots.join(whole, F.col("tree") == F.col("t"), "left_semi").select(
            "tree", F.lit(0).cast("long").alias("index"), "proof")
        known = own if known is None else own.unionAll(known)
        if segments is not rounds[0]:
            known = materialize(_lowest(_hung(segments, known), depth).drop("digest"), "merkle-proofs")
    return known


def with_proofs(manifest: Manifest) -> DataFrame:
    """The leaves with ``proof`` (an array, from the leaf's run up to the root's, each level the
    digests of one run with HERE in the place of the one below), ``subroot`` and ``root``."""
    leaves, depth, spark = manifest.leaves, manifest.depth, manifest.leaves.sparkSession
    if not manifest.log:
        return leaves.withColumns({"proof": F.array().cast("array<string>"), "subroot": F.col("digest"),
                                   "root": F.col("digest")})
    roots = spark.range(1).select(F.col("id").alias("tree"), F.array().cast("array<string>").alias("proof"))
    groups = _lowest(_hung(manifest.upper[0], _proofs_of_tops(manifest.upper, roots, depth)), depth)
    groups = materialize(groups.select(F.col("index").alias("tree"), "proof", F.col("digest").alias("subroot")),
                         "merkle-roots")
    segments = _hung(manifest.log[0], _proofs_of_tops(manifest.log, groups, depth))
    segments = segments.join(groups.select(F.col("tree").alias("t"), "subroot"), F.expr("tree = t")).drop("t")

    size = FAN ** depth
    schema = T.StructType([*leaves.schema, T.StructField("proof", T.ArrayType(T.StringType())),
                           T.StructField("subroot", T.StringType())])

    def run(rows: pa.Table, segment: pa.Table) -> pa.Table:
        (s,) = segment.to_pylist()
        _, proofs = block_proofs(s["nodes"], s["n"], s["block"], depth)
        at = [i - s["block"] * size for i in rows.column("index").to_pylist()]
        return rows.drop_columns(["block"]).append_column(
            "proof", pa.array([[*proofs[i], *s["proof"]] for i in at], pa.list_(pa.string()))).append_column(
            "subroot", pa.array([s["subroot"]] * len(at), pa.string()))

    placed = leaves.withColumn("block", F.expr(f"`index` div {size}"))
    found = placed.groupBy("tree", "block").cogroup(segments.groupBy("tree", "block")).applyInArrow(run, schema)
    return found.withColumn("root", F.lit(manifest.root()))
