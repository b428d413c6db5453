"""Near duplicates by order-preserving MinHash, verified by banded alignment.

A sketch holds the few smallest hashes among a text's five-word shingles, each labelled with its
occurrence number, and keeps them in text order. Two texts share a sketch when the same shingles
are smallest in both and stand in the same order, which follows their edit similarity. Texts that
share a sketch are candidates; a pair is a link when at least ``similarity`` of the longer text's
words align, in order, with words of the shorter.

Work per sketch value is linear: all texts with it are compared with the smallest one first. Only
where that leaves texts in different classes are the pairs across classes compared. Where those
would be very many, as with a passage that many texts hold, they are first compared in blocks by a
signature of their words, which leaves out pairs that cannot align, and only those: texts of which
80 % align differ in few of its bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh3_64_intdigest

from lakesteps.llm.common import free_name, per_text, slices, text_or_empty
from lakesteps.llm.components import components
from lakesteps.session import materialize

SHINGLE = 5
#: Hashes in a sketch, and sketches per text. Texts whose shingles are 80 % alike share one of the
#: 40 with probability 1 - 5e-10, 70 % alike 1 - 2e-5, 60 % alike 0.996.
MINIMA, SKETCHES = 4, 40
SIMILARITY = 0.8
#: A sketch value that would take more comparisons across classes is compared by signatures first,
#: in blocks of about so many texts.
CROWD, BLOCK = 1000, 256
#: Buckets in which words are counted for their rarity, and 64-bit parts of a signature.
BUCKETS, PARTS = 1 << 18, 64
WORD = re.compile(r"\w+")


class _WordHashes(dict):
    """64-bit hash of a word, kept for words seen before; emptied when it grows large."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def words_of(text: str) -> list[str]:
    """Lower-case words without punctuation, as compared here."""
    return WORD.findall(text.lower())


def shingles(words: list[str]) -> np.ndarray:
    """Hashes of the five-word shingles, equal ones told apart by occurrence number.

    A text of fewer words is one shingle; a text without words has none.
    """
    w = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    if not len(w):
        return w
    n = max(1, len(w) - SHINGLE + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, len(w))):
        out = out * np.uint64(0x9E3779B97F4A7C15) + w[k:k + n]
        out ^= out >> np.uint64(29)
    return _numbered(out)


def _numbered(hashes: np.ndarray) -> np.ndarray:
    """The hashes, in place, with equal ones told apart by occurrence number."""
    n = len(hashes)
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    if len(first) < n:
        number = np.arange(n) - np.repeat(first, np.diff(np.r_[first, n]))
        hashes[order] += number.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return hashes


def _buckets(words: list[str]) -> np.ndarray:
    w = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    return (w % np.uint64(BUCKETS)).astype(np.int64)


def _numbered_words(words: list[str]) -> np.ndarray:
    return _numbered(np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words)))


def _signature(w: np.ndarray) -> np.ndarray:
    """The parity of the words in each of 64 * PARTS bits: texts differ in no more bits than words."""
    mixed = (w ^ (w >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    bits = np.bincount((mixed >> np.uint64(32)).astype(np.int64) % (64 * PARTS), minlength=64 * PARTS) & 1
    return np.packbits(bits.astype(np.uint8))


def signature(words: list[str]) -> bytes:
    """The signature of words told apart by occurrence number."""
    return _signature(_numbered_words(words)).tobytes()


def rare_words(words: list[str], counts: np.ndarray, least: float) -> tuple[list[int], list[int]]:
    """The words of which two texts share one if they align, and a signature, as 64-bit integers.

    Words are told apart by occurrence number and put in one order for all texts, rare ones (by
    the counts of their buckets) first. Of n words at least ``least`` align with equal words, so
    the first of those is among the first (1 - least) * n + 1 in both texts.
    """
    n = len(words)
    w = _numbered_words(words)
    first = np.lexsort((w, counts[_buckets(words)]))[:n - int(np.ceil(least * n - 1e-9)) + 1]
    return w[first].view(np.int64).tolist(), _signature(w).view(np.int64).tolist()


@lru_cache(maxsize=8)
def _permutations(sketches: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(7)
    scale, shift = random.integers(1 << 63, size=(2, sketches, 1), dtype=np.uint64)
    return scale * np.uint64(2) + np.uint64(1), shift


def sketch(text: str, minima: int = MINIMA, sketches: int = SKETCHES) -> list[int]:
    """Order-preserving sketches as 64-bit integers; none for a text without words."""
    x = shingles(words_of(text))
    n, small = len(x), min(minima, len(x))
    if not n:
        return []
    scale, shift = _permutations(sketches)
    rows, keys = max(1, 2_000_000 // n), []
    for at in range(0, sketches, rows):  # some permutations at a time, so long texts fit
        h = x * scale[at:at + rows] + shift[at:at + rows]
        lowest = np.argpartition(h, small - 1, axis=1)[:, :small] if small < n else (
            np.broadcast_to(np.arange(n), (len(h), n)))
        chosen = x[np.sort(lowest, axis=1)]
        key = shift[at:at + rows, 0].copy()
        for k in range(small):
            key = (key ^ chosen[:, k]) * np.uint64(0x9FB21C651E98DF25)
            key ^= key >> np.uint64(32)
        keys.append(key)
    return np.concatenate(keys).view(np.int64).tolist()


def aligned_share(a: list[str], b: list[str], least: float = SIMILARITY) -> float:
    """Words of the longer text that align in order with the shorter, as a share; 0 if below least.

    A longest-common-subsequence alignment, one bit per word of ``a`` and one big-integer step per
    word of ``b``. Only matches within the band that ``least`` allows are considered; the band is
    as wide as the words that may stay unaligned, so no alignment that counts is missed.
    """
    longer = max(len(a), len(b))
    if not longer or min(len(a), len(b)) < least * longer:
        return 0.0
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    x, y = a[start:len(a) - end], b[start:len(b) - end]
    same = start + end
    band = int((1 - least) * longer) + 1
    at: dict[str, int] = {}
    for i, word in enumerate(x):
        at[word] = at.get(word, 0) | (1 << i)
    spare = len(y) - int(np.ceil(least * longer - 1e-9)) + same  # words of y that may not match
    if sum(word not in at for word in y) > spare:
        return 0.0
    full = (1 << len(x)) - 1
    v, window = full, (1 << (2 * band + 1)) - 1
    for j, word in enumerate(y):
        match = at.get(word, 0)
        if match:
            match &= window << (j - band) if j >= band else window >> (band - j)
            u = v & match
            v = ((v + u) | (v - u)) & full
    same += len(x) - v.bit_count()
    return same / longer if same >= least * longer - 1e-9 else 0.0


#: Steps (in a, in b) tried in this order where two words differ.
_STEPS = sorted(((i, j) for i in range(7) for j in range(7) if i + j), key=lambda s: (sum(s), s))


def aligns(a: list[str], b: list[str], least: float = SIMILARITY) -> bool:
    """Whether ``aligned_share`` reaches ``least``.

    Close texts are settled by one walk that steps over small differences: the words it pairs are
    an alignment, so enough of them prove the answer. Others take the full alignment.
    """
    longer = max(len(a), len(b))
    if not longer or min(len(a), len(b)) < least * longer:
        return False
    need, i, j, same = least * longer - 1e-9, 0, 0, 0
    spare = longer - need + 1
    while i < len(a) and j < len(b) and spare > 0:
        if a[i] == b[j]:
            i, j, same = i + 1, j + 1, same + 1
            if same >= need:
                return True
            continue
        for di, dj in _STEPS:
            if i + di < len(a) and j + dj < len(b) and a[i + di] == b[j + dj]:
                break
        i, j, spare = i + di, j + dj, spare - max(di, dj)
    return aligned_share(a, b, least) > 0


def _verify(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts align."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(slices([whole], "text_a"), "text_b"):
                known = ("", [])
                keep = []
                for s, t in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
                    if s != known[0]:
                        known = (s, words_of(s))
                    keep.append(aligns(known[1], words_of(t), similarity))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _open_spots(spots: DataFrame, comps: DataFrame) -> DataFrame:
    """``spots`` (node, n, key, ...) of values in more than one class, with class and weight.

    lone: not of the class most frequent there; all, most: the texts there, and those of that class;
    cross: the number of comparisons it would take.
    """
    rest = [c for c in spots.columns if c not in ("key", "node")]
    placed = spots.join(comps, "node", "left").select(
        "key", "node", *rest, F.coalesce("comp", "node").alias("comp"))
    sizes = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("size"))
    keys = sizes.groupBy("key").agg(
        F.sum("size").alias("all"), F.max("size").alias("most"),
        F.max_by("comp", F.struct("size", "comp")).alias("main")
    ).where("all > most").withColumn("cross", F.expr("all * (all - most)"))
    return materialize(placed.join(keys, "key").withColumn("lone", F.expr("comp != main")), "sketch-open")


def _across(spots: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) with one value and different classes, each pair of a value once.

    Texts whose numbers of words differ too much to align are no pair.
    """
    some = spots.where("lone").select(
        "key", F.col("node").alias("x"), F.col("n").alias("n_x"), F.col("comp").alias("comp_x"))
    fits = (F.expr("comp_x < comp or (comp_x != comp and not lone)")
            & (F.least("n_x", "n") >= similarity * F.greatest("n_x", "n") - 1e-9))
    return some.join(spots, "key").where(fits).select(
        F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b"))


def _across_crowds(spots: DataFrame, bodies: DataFrame, similarity: float) -> DataFrame:
    """What ``_across`` gives, each pair once, without pairs whose signatures differ too much to align.

    Lone texts of a value and all its texts are dealt into blocks, and each block of the one is
    compared with each of the other inside a task: pairs that cannot align never become rows. A
    pair that shares several values comes from the smallest.
    """
    held = materialize(spots.groupBy("node").agg(F.collect_set("key").alias("keys")), "sketch-values")
    crowded = materialize(bodies.join(held.hint("shuffle_hash"), "node").select("node", "keys", "text"), "sketch-crowd")
    marks = materialize(per_text(crowded, lambda ts: [(signature(words_of(t)),) for t in ts], "bits binary"), "sketch-crowd")
    blocks = spots.withColumns({
        "of_all": F.ceil(F.col("all") / BLOCK), "of_lone": F.ceil((F.col("all") - F.col("most")) / BLOCK)})
    rows = ["key", "node", "n", "comp", "lone"]
    every = blocks.select(
        *rows, F.lit(False).alias("first"), F.expr("pmod(xxhash64(node), of_all)").alias("i"),
        F.explode(F.expr("sequence(0L, of_lone - 1)")).alias("j"))
    lone = blocks.where("lone").select(
        *rows, F.lit(True).alias("first"), F.explode(F.expr("sequence(0L, of_all - 1)")).alias("i"),
        F.expr("pmod(xxhash64(node, 1), of_lone)").alias("j"))

    def compare(block: pa.Table) -> pa.Table:
        key = block.column("key")[0].as_py()
        node, n, comp, alone, first = (block.column(c).to_numpy() for c in ("node", "n", "comp", "lone", "first"))
        bits = np.frombuffer(b"".join(block.column("bits").to_pylist()), np.uint64).reshape(len(node), -1)
        keys = [set(k) for k in block.column("keys").to_pylist()]
        others, pairs = np.flatnonzero(~first), []
        for x in np.flatnonzero(first):
            long, short = np.maximum(n[x], n[others]), np.minimum(n[x], n[others])
            fits = (comp[x] < comp[others]) | ((comp[x] != comp[others]) & ~alone[others])
            some = others[fits & (short >= similarity * long - 1e-9)]
            apart = np.bitwise_count(bits[some] ^ bits[x]).sum(axis=1, dtype=np.int64)
            most = n[x] + n[some] - 2 * (similarity * np.maximum(n[x], n[some]) - 1e-9)
            pairs += ((x, y) for y in some[apart <= most] if min(keys[x] & keys[y]) == key)
        both = node[np.array(pairs, np.int64).reshape(-1, 2)]
        return pa.table({"a": both.min(axis=1), "b": both.max(axis=1)})

    return every.union(lone).join(marks, "node").groupBy("key", "i", "j").applyInArrow(compare, "a long, b long")


def near_classes(docs: DataFrame, id: str = "doc_id", text: str = "text",
                 similarity: float = SIMILARITY, minima: int = MINIMA, sketches: int = SKETCHES,
                 crowd: int = CROWD) -> DataFrame:
    """One row per text digest: digest, node (smallest id of the text), class_id, n_texts.

    node and class_id are null only if every row of the text has a null id.
    """
    rows = docs.select(F.col(f"`{id}`").cast("long").alias("id"), text_or_empty(text).alias("text"))
    rows = rows.withColumn("digest", F.sha2("text", 256))
    made = per_text(rows, lambda ts: [(sketch(t, minima, sketches), len(words_of(t))) for t in ts],
                    "sketch array<long>, n long")
    texts = materialize(made.groupBy("digest").agg(
        F.min("id").alias("node"), F.any_value("sketch").alias("sketch"),
        F.any_value("n").alias("n")), "sketches")
    # Texts with one sketch value, beside another text.
    spots = texts.where("node is not null").select("node", "n", F.explode("sketch").alias("key"))
    heads = spots.groupBy("key").agg(
        F.min("node").alias("head"), F.count(F.lit(1)).alias("size")).where("size > 1")
    members = materialize(spots.join(heads, "key").drop("size"), "sketch-members")
    stars = materialize(
        members.where("node != head").select(F.col("head").alias("a"), F.col("node").alias("b"))
        .distinct(), "sketch-pairs")
    named = stars.select(F.col("a").alias("node")).union(stars.select("b")).distinct()
    wanted = texts.select("digest", "node", "n").join(named, "node")
    bodies = materialize(
        rows.select(F.col("id").alias("node"), "digest", "text")
        .join(wanted.hint("shuffle_hash"), ["digest", "node"]).select("node", "n", "text"),
        "sketch-texts")
    links = materialize(_verify(stars, bodies, similarity), "links")
    # What the stars leave apart: pairs across classes that share a sketch.
    comps = components(links)
    spread = _open_spots(members, comps)
    cheap = F.col("cross") <= crowd
    near = _across_crowds(spread.where(~cheap), bodies, similarity)
    across = _across(spread.where(cheap), similarity).union(near).distinct()
    across = across.join(stars, ["a", "b"], "left_anti")
    more = _verify(across, bodies, similarity)
    classes = components(links.unionByName(more))
    return texts.select("digest", "node").join(
        classes, "node", "left").select("digest", "node", F.coalesce("comp", "node").alias("class_id"))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row per row of ``docs``: id, class_id (the smallest id of its group), kept.

    Documents with one text, and texts linked directly or over others, share a class; kept marks
    the document that stays, whose id is the class_id. Texts without words (null, empty,
    punctuation only) are alike only if identical, null being empty. A row with a null id takes
    part through its text; it never stays where its class has an id, and has a null class_id where
    it has none. Repeated rows get the same answer each. Other columns are ignored.
    """
    classes = near_classes(docs, id, text, **how)
    rows = docs.select(F.col(f"`{id}`").alias(id), F.sha2(text_or_empty(text), 256).alias("__digest"))
    joined = rows.join(classes.withColumnRenamed("digest", "__digest"), "__digest")
    return joined.select(id, "class_id", F.col(id).eqNullSafe(F.col("class_id")).alias("kept"))


def keep_one_of_class(docs: DataFrame, id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` with the documents that stay; columns as they are.

    Rows that repeat the id and text that stay are all kept, as is a text whose ids are all null.
    """
    classes = near_classes(docs, id, text, **how).where("node <=> class_id")
    digest, node = free_name(docs, "__near_digest"), free_name(docs, "__near_node")
    marked = docs.withColumn(digest, F.sha2(text_or_empty(text), 256))
    stay = classes.select(F.col("digest").alias(digest), F.col("node").alias(node))
    return marked.join(stay.hint("shuffle_hash"), (marked[digest] == stay[digest])
                       & marked[id].eqNullSafe(stay[node]), "left_semi").drop(digest)
