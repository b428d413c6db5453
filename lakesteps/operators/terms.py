"""Find which terms of a table occur in which texts, without comparing every term with every text.

An inverted index over character n-grams: a term is filed under one of its grams, the one that fewest
texts hold, and a text meets only the terms filed under a gram of its own. A term all of whose grams
are common is thus still filed under the least common one, and one with a gram that no text holds is
dropped at once. Each meeting is then checked by looking for the term, so the result is exact.

Of a text only every STRIDE-th gram is taken, which makes a fourth of the grams. A term is filed once
per place modulo the stride, as any of these may fall on the text's grams; the phase in which its
first occurrence lies is the one that counts, so no pair comes twice.

Grams are 64-bit codes that numpy makes of whole batches of texts, and a filter of the index's codes
thins them before anything else is done with them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lakesteps.session import materialize

#: (least length of a term, length of its grams, stride of the text's grams), the first that fits.
CLASSES = ((8, 5, 4), (3, 3, 1), (1, 1, 1))
#: Bits of the filter that thins a text's grams before they become rows: 512 KiB whatever the number
#: of terms. Grams it lets through by chance cost time and change nothing.
FILTER_BITS = 22
#: Characters whose grams are worked out at once, at about 40 bytes each.
CHARS_AT_ONCE = 2_000_000
#: Texts that one task may meet under one gram before the gram is dealt to several.
ROWS_PER_GRAM = 1_000_000


#: An index measured to be no larger goes to every task; a larger one is shuffled with the hits.
BROADCAST_BYTES = 16 << 20
#: Tasks that one gram is dealt to at most, as every row of the index is there for each.
MOST_DEALS = 64


def _codes(points: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit code for each stretch of ``width`` characters. Two that share one cost time and change nothing."""
    n = max(0, len(points) - width + 1)
    code = np.full(n, width, np.uint64)
    for k in range(width):
        code ^= points[k:k + n]
        code *= np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(32)
    return code


def _grams(texts: list[str], width: int, stride: int, bits: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text and code of its gram at every ``stride``-th place; with ``bits``, of those only that it lets through."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    code = _codes(points, width)
    at = np.arange(len(code)) if bits is None else np.flatnonzero(bits[code & np.uint64(len(bits) - 1)])
    text = np.searchsorted(ends, at, "right")
    start = np.r_[0, ends][text]
    own = (at + width <= ends[text]) & ((at - start) % stride == 0)
    return text[own], code[at[own]]


def _parts(texts: list[str]) -> Iterator[list[str]]:
    """``texts`` in runs of at most CHARS_AT_ONCE characters, or one text."""
    first = size = 0
    for k, text in enumerate(texts):
        if k > first and size + len(text) > CHARS_AT_ONCE:
            yield texts[first:k]
            first, size = k, 0
        size += len(text)
    yield texts[first:]


def _coded(rows: DataFrame, text: str, classes: list[tuple[int, int, int]], bitmap=None) -> DataFrame:
    """``rows`` with ``grams``, the codes of the text's grams: in order, or with ``bitmap`` the distinct ones it lets through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if bitmap is None else np.unpackbits(np.frombuffer(bitmap.value, np.uint8), bitorder="little").view(bool)
        for batch in batches:
            sizes, codes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for some in _parts(batch.column(text).to_pylist()):
                found = [_grams(some, width, stride, bits) for _, width, stride in classes]
                no, code = (np.concatenate(x) for x in zip(*found))
                if bits is not None:
                    order = np.lexsort((code, no))
                    no, code = no[order], code[order]
                    new = np.r_[True, (no[1:] != no[:-1]) | (code[1:] != code[:-1])][:len(no)]
                    no, code = no[new], code[new]
                sizes.append(np.bincount(no, minlength=len(some)))
                codes.append(code.view(np.int64))
            ends = np.r_[0, np.cumsum(np.concatenate(sizes))].astype(np.int32)
            grams = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(codes)))
            yield pa.RecordBatch.from_arrays([*batch.columns, grams], names=[*batch.schema.names, "grams"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("grams", T.ArrayType(T.LongType()))]))


def _bitmap(grams: DataFrame):
    """FILTER_BITS bits, those of ``gram`` set, for every task. The driver sees them as at most 65,536 numbers."""
    place = F.col("gram").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    bits = grams.select(F.shiftright(place, 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(gram & 63 as int))").alias("bit"))
    words, table = np.zeros(1 << (FILTER_BITS - 6), np.int64), bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    words[table.column("word").to_numpy()] = table.column("bits").to_numpy()
    return grams.sparkSession.sparkContext.broadcast(words.tobytes())


def _hits(texts: DataFrame, classes: list[tuple[int, int, int]], bitmap) -> DataFrame:
    """``texts`` with one row per distinct gram that passes the filter."""
    return _coded(texts, "__text", classes, bitmap).withColumn("gram", F.explode("grams")).drop("grams")


def term_matches(texts: DataFrame, terms: DataFrame, id: str, text: str, term_id: str, term: str,
                 ignore_case: bool = True) -> DataFrame:
    """(id, term_id) for every row of ``texts`` whose text contains a row's term of ``terms``.

    Equal terms are looked for once and given back under each of their ids. Null texts hold nothing,
    null and empty terms are in no text; repeated rows count each. Texts are read twice: to count
    how many hold each gram that a term could be filed under, and to look up the rarest. Neither step shuffles texts
    while the index is measured to be under BROADCAST_BYTES; beyond that a text is sent once per gram
    it shares with the index, and grams that very many texts hold go to several tasks. About 80 bytes per character of one text are held at a time.
    """
    form = F.lower if ignore_case else (lambda c: c)
    rows = texts.where(F.col(f"`{text}`").isNotNull()).select(
        F.col(f"`{id}`").alias("__id"), form(F.col(f"`{text}`")).alias("__text"))
    named = terms.select(F.col(f"`{term_id}`").alias("__term_id"), form(F.col(f"`{term}`")).alias("__term")).where("__term != ''")
    length, by_class = F.length("__term"), F.lit(None).cast("int")
    for k, (least, _, _) in reversed([*enumerate(CLASSES)]):
        by_class = F.when(length >= least, F.lit(k)).otherwise(by_class)
    wanted = materialize(named.select("__term").distinct().withColumn("class", by_class), "terms")
    used = sorted(r[0] for r in wanted.select("class").distinct().collect())  # at most len(CLASSES)
    if not used:
        return rows.join(named, F.lit(False)).select(F.col("__id").alias(id), F.col("__term_id").alias(term_id))
    parts = []
    for k in used:
        _, width, stride = CLASSES[k]
        own = _coded(wanted.where(F.col("class") == k), "__term", [(0, width, 1)]).select(
            "__term", "class", F.posexplode("grams").alias("at", "gram"))
        parts.append(own.select("__term", "class", F.lit(stride).alias("stride"), (F.col("at") % stride).alias("phase"), "gram"))
    filed = materialize(reduce(DataFrame.unionAll, parts).distinct(), "term-grams")
    # where a term has a choice, how many texts hold each of its grams
    choice = filed.groupBy("__term", "phase").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__term", "phase")
    open_grams = materialize(filed.join(choice, ["__term", "phase"], "left_semi").select("class", "gram").distinct(), "term-choice")
    unsure = sorted(r[0] for r in open_grams.select("class").distinct().collect())
    held = filed.select("gram", F.lit(None).cast("long").alias("n_texts")).limit(0)
    if unsure:
        held = _hits(rows, [CLASSES[k] for k in unsure], _bitmap(open_grams)).groupBy("gram").agg(
            F.count(F.lit(1)).alias("n_texts")).join(open_grams.select("gram").distinct(), "gram", "left_semi")
        known = open_grams.select("gram").distinct().join(held, "gram", "left").select("gram", F.coalesce("n_texts", F.lit(0)).alias("n_texts"))
        held = materialize(known, "term-counts")
    index = filed.join(held, "gram", "left").groupBy("__term", "stride", "phase").agg(
        F.min("n_texts").alias("n_texts"),
        F.min_by("gram", F.struct(F.coalesce("n_texts", F.lit(1 << 62)).alias("n"), F.col("gram").alias("g"))).alias("gram"))
    index = materialize(index.where("n_texts is null or n_texts > 0"), "term-index")
    most, uncounted = index.agg(F.max("n_texts"), F.count_if(F.col("n_texts").isNull())).first()
    most = texts.count() if uncounted else most or 0
    deals = min(MOST_DEALS, -(-most // ROWS_PER_GRAM) or 1)
    dealt = index.select("__term", "stride", "phase", "gram", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))).alias("deal"))
    hits = _hits(rows, [CLASSES[k] for k in used], _bitmap(index.select("gram").distinct())).withColumn(
        "deal", F.pmod(F.xxhash64("__id"), F.lit(deals)).cast("int"))
    if (index.agg(F.sum(F.octet_length("__term") + 64)).first()[0] or 0) * deals <= BROADCAST_BYTES:
        dealt = F.broadcast(dealt)
    # the place of the first occurrence is needed only where a term is filed in several phases
    in_phase = F.when(F.col("stride") == 1, F.lit(True)).otherwise(
        F.pmod(1 - F.instr(F.col("__text"), F.col("__term")), "stride") == F.col("phase"))
    found = hits.join(dealt, ["gram", "deal"]).where(F.contains("__text", "__term")).where(in_phase)
    return found.select("__id", "__term").join(named, "__term").select(
        F.col("__id").alias(id), F.col("__term_id").alias(term_id))
