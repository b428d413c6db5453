"""Find runs of repeated word sequences by internal pattern matching.

A run is a stretch of words with smallest period q, at least two periods and MIN_LENGTH words long,
that no neighbouring word extends. Texts are put one after the other, each closed by a word of its
own, and the following is worked out for all of them at once in numpy:

1. The classes of equal stretches of 1, 2, 4, ... words (the basic factors) by prefix doubling; their
   order gives the suffix array, in which each class is an interval.
2. A wavelet tree over the suffix array answers range successor: the first place from v on among
   the suffixes of an interval.
3. Blocks of 2^k words at multiples of 2^k ask for their own occurrences in the neighbouring windows
   that lie 2 * 2^k - 1 to 4 * 2^k - 2 words on. A run of a period in that range holds such a block in
   the part that its period copies, so each run answers some block. Occurrences of a block in a window
   no longer than itself form one arithmetic progression, known by first, second and number.
4. Each distance in a progression is a candidate period; equal stretches before and after, by the
   basic factors from long to short, show how far it reaches.

Everything is within a text, so the step is map only. Memory is about 60 bytes a word of one slice,
and one text, however long, is one slice at least; work is O(n log n) also where all words are equal.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lakesteps.llm.common import slices

WORD = re.compile("[^\x20\x09-\x0D]+")
MIN_LENGTH = 12
#: Bytes of text worked on at once, or one text.
SLICE_BYTES = 1 << 20


class WaveletTree:
    """A sequence of numbers below ``size``, level by level from the highest bit; the zeros of a
    level go before its ones. Bits are packed, with a count before every 64."""

    def __init__(self, values: np.ndarray, size: int):
        self.depth = max(1, int(size - 1).bit_length())
        self.levels, n = [], len(values)
        for bit in range(self.depth - 1, -1, -1):
            ones = (values >> bit) & 1 == 1
            packed = np.zeros((n // 64 + 1) * 8, np.uint8)
            bits = np.packbits(ones, bitorder="little")
            packed[:len(bits)] = bits
            words = packed.view(np.uint64)
            before = np.zeros(len(words), np.int32)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            zeros = values[~ones]
            self.levels.append((words, before, len(zeros), bit))
            values = np.concatenate([zeros, values[ones]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ones among the first ``at`` bits of a level."""
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[at >> 6] + np.bitwise_count(words[at >> 6] & low).astype(np.int64)

    def below(self, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many of the numbers at places lo to hi (exclusive) are smaller than ``value``."""
        count = np.where(value >> self.depth > 0, hi - lo, 0)
        lo, hi = np.where(count > 0, 0, lo), np.where(count > 0, 0, hi)
        for words, before, zeros, bit in self.levels:
            a, b = self._ones(words, before, lo), self._ones(words, before, hi)
            one = (value >> bit) & 1 == 1
            count += np.where(one, (hi - b) - (lo - a), 0)
            lo, hi = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, hi - b)
        return count

    def smallest(self, lo: np.ndarray, hi: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The number of the given rank (0: smallest) at places lo to hi."""
        found = np.zeros(len(lo), np.int64)
        for words, before, zeros, bit in self.levels:
            a, b = self._ones(words, before, lo), self._ones(words, before, hi)
            n_zeros = (hi - b) - (lo - a)
            one = rank >= n_zeros
            rank = np.where(one, rank - n_zeros, rank)
            lo, hi = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, hi - b)
            found |= one.astype(np.int64) << bit
        return found


def basic_factors(codes: np.ndarray, levels: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Classes of the stretches of 2^0 to 2^levels words, and the suffix array.

    A class is named by the place of its first suffix in the suffix array. The last code must occur
    once. Only stretches that occur again are sorted further; levels end early when none is left.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    first = np.ones(n, bool)
    first[1:] = codes[order][1:] != codes[order][:-1]
    starts = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n, np.int32)
    rank[order] = starts
    suffixes = order.astype(np.int32)
    ranks, span = [rank], 1
    again = ~first
    again[:-1] |= ~first[1:]
    active = order[again]  # in the order of their classes
    while len(ranks) <= levels and len(active):
        old = rank[active].astype(np.int64)
        key = old * (n + 1) + rank[np.minimum(active + span, n - 1)]
        by = np.argsort(key, kind="stable")
        active, key, old = active[by], key[by], old[by]
        m, at = len(active), np.arange(len(active))
        fresh = np.ones(m, bool)
        fresh[1:] = old[1:] != old[:-1]
        within = at - np.maximum.accumulate(np.where(fresh, at, 0))
        suffixes[old + within] = active
        fresh[1:] = key[1:] != key[:-1]
        new = (old + within)[np.maximum.accumulate(np.where(fresh, at, 0))]
        rank = rank.copy()
        rank[active] = new
        ranks.append(rank)
        again = ~fresh
        again[:-1] |= ~fresh[1:]
        active, span = active[again], span * 2
    return ranks, suffixes


def _reach(ranks: list[np.ndarray], i: np.ndarray, j: np.ndarray, back: bool) -> np.ndarray:
    """How many words from i and j on (before them, if ``back``) are equal."""
    total, n, level = np.zeros(len(i), np.int64), len(ranks[0]), len(ranks) - 1
    while level >= 0:
        rank, size = ranks[level], 1 << level
        x, y = (i - total - size, j - total - size) if back else (i + total, j + total)
        inside = (np.minimum(x, y) >= 0) & (np.maximum(x, y) < n)
        same = inside & (rank[np.where(inside, x, 0)] == rank[np.where(inside, y, 0)])
        total += np.where(same, size, 0)
        if level < len(ranks) - 1 or not same.any():  # the longest stretch may fit again
            level -= 1
    return total


def find_runs(codes: np.ndarray, longest: int, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period.

    ``codes`` holds texts of at most ``longest`` words, each followed by a code that occurs once.
    """
    if min_length < MIN_LENGTH:
        raise ValueError(f"runs are found from {MIN_LENGTH} words on")
    empty = np.zeros((0, 3), np.int64)
    if longest < min_length:
        return empty
    levels = max(2, (longest // 4 + 1).bit_length())
    ranks, suffixes = basic_factors(codes, levels)
    sizes = [np.bincount(r, minlength=len(r)) for r in ranks[1:]]
    tree, found = WaveletTree(suffixes, len(codes)), [empty]
    for level in range(1, len(ranks)):
        block = 1 << level
        at = np.arange(0, len(codes), block)
        left = ranks[level][at].astype(np.int64)
        size = sizes[level - 1][left]
        at, left, size = at[size > 1], left[size > 1], size[size > 1]
        # blocks of 4 see all periods up to 14 but 6, as a run has 12 words at least
        near, far = {1: (6, 6), 2: (1, 14)}.get(level, (2 * block - 1, 4 * block - 2))
        for start in range(near, far + 1, block):
            lo = at + start
            hi = np.minimum(lo + block, at + far + 1)
            skip = tree.below(left, left + size, lo)
            number = tree.below(left, left + size, hi) - skip
            hit = number > 0
            if not hit.any():
                continue
            p, a, s, skipped, count = at[hit], left[hit], size[hit], skip[hit], number[hit]
            first = tree.smallest(a, a + s, skipped)
            more = count > 1
            second = first.copy()
            second[more] = tree.smallest(a[more], (a + s)[more], skipped[more] + 1)
            # the progression first, second, ... of count places: one candidate period each
            row = np.repeat(np.arange(len(p)), count)
            step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            place = first[row] + step * (second - first)[row]
            period = place - p[row]
            begin = p[row] - _reach(ranks, p[row], place, True)
            length = place + _reach(ranks, p[row], place, False) - begin
            good = length >= np.maximum(min_length, 2 * period)
            found.append(np.stack([begin, length, period], 1)[good])
    rows = np.concatenate(found)
    # of the periods of one stretch the smallest counts
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    rows = rows[new]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def runs_of_texts(texts: list[list[str]], min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (start, length, period), how many each text has, and per word and text end whether a
    run repeats it there, as one array over all texts. Starts count within the text."""
    known: dict[str, int] = {}
    codes = []
    for words in texts:
        codes.extend([known.setdefault(w, len(known)) for w in words])
        codes.append(-1)
    codes = np.array(codes, np.int64)
    ends = np.flatnonzero(codes < 0)
    codes[ends] = len(known) + np.arange(len(ends))
    lengths = np.array([len(w) for w in texts], np.int64)
    begins = ends - lengths
    runs = find_runs(codes, int(lengths.max(initial=0)), min_length)
    change = np.zeros(len(codes) + 1, np.int32)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    repeated = np.cumsum(change[:-1]) > 0
    text = np.searchsorted(ends, runs[:, 0])
    runs[:, 0] -= begins[text]
    return runs, np.bincount(text, minlength=len(texts)), repeated


ADDED = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("runs", T.ArrayType(T.StructType([
        T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))),
    T.StructField("collapsed", T.StringType()),
])


def periodic_runs(docs: DataFrame, id: str = "doc_id", text: str = "text",
                  min_length: int = MIN_LENGTH) -> DataFrame:
    """One row per row of ``docs``: id, n_words, runs, collapsed.

    ``runs`` is an array of (start, length, period) in words, by start and period. ``collapsed`` is
    the text with one blank between words and without those that repeat: a word is left out if a
    run contains it after the run's first period. Texts that are null, empty or blank have no words
    and no runs, and '' is their collapsed text. A null id passes through, repeated rows get the
    same answer each, other columns are ignored.
    """
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), *ADDED.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in slices(batches, size=SLICE_BYTES):
            texts = [WORD.findall(t) if t else [] for t in batch.column("text").to_pylist()]
            runs, counts, repeated = runs_of_texts(texts, min_length)
            collapsed, at = [], 0
            for words in texts:
                gone = repeated[at:at + len(words)]
                collapsed.append(" ".join(
                    [words[i] for i in np.flatnonzero(~gone)] if gone.any() else words))
                at += len(words) + 1
            kind = arrow.field("runs").type
            columns = [pa.array(runs[:, k]) for k in range(3)]
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            listed = pa.ListArray.from_arrays(
                offsets, pa.StructArray.from_arrays(columns, fields=list(kind.value_type)), type=kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(w) for w in texts], pa.int64()), listed,
                 pa.array(collapsed, pa.string())], schema=arrow)

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id)
