"""Large CSV files cut into blocks that are parsed at once, line breaks inside quotes included.

Whether a line break ends a record depends on the number of quotes before it, back to the start of the
file. That number need not be known block by block, only its parity: one pass counts each block's
quotes, the running parity over a file's blocks says which of them begin inside a quoted value, and
with that every block finds its own records. What a block holds before its first record and after its
last one are two ends of records that go over a border; they are put together by their blocks.
"""

from __future__ import annotations

import csv as csv_module
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

#: Characters of whole records handed on at once.
OUT_CHARS = 4 << 20


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The physical lines with file and block, in order within a block; a CR before the LF is kept."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_block_start").alias("block"), "value")


def _borders(lines: DataFrame) -> tuple[dict[str, set[int]], list[tuple[str, int]]]:
    """Per file the blocks that begin inside a quoted value, and all blocks at such borders.

    Of each such border two numbers reach the driver. 100 TB in blocks of 128 MB have 800,000 blocks
    and so at most as many borders, of which those count that fall into a quoted value.
    """
    quotes = lines.groupBy("file", "block").agg(
        F.sum(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"))
    order = Window.partitionBy("file").orderBy("block")
    odd = quotes.withColumns({
        "before": F.sum("quotes").over(order.rowsBetween(Window.unboundedPreceding, -1)),
        "former": F.lag("block").over(order)}).where("before % 2 = 1").select("file", "block", "former")
    inside: dict[str, set[int]] = {}
    touched = set()
    for file, block, former in zip(*(c.to_pylist() for c in odd.toArrow().columns)):
        inside.setdefault(file, set()).add(block)
        touched |= {(file, block), (file, former)}
    return inside, sorted(touched)


class _Block:
    """The records of one block, given batch by batch."""

    def __init__(self, file: str, block: int, inside: bool):
        self.file, self.block, self.open = file, block, inside
        self.parts: list[str] = []  # lines of the record in hand
        self.head = inside  # the record in hand began in an earlier block

    def take(self, lines: list[str], quotes: list[int]) -> Iterator[tuple[str, str]]:
        for line, n in zip(lines, quotes):
            self.parts.append(line)
            self.open ^= n & 1 == 1
            if not self.open:
                yield ("end" if self.head else "whole"), "\n".join(self.parts)
                self.parts, self.head = [], False

    def rest(self) -> Iterator[tuple[str, str]]:
        if self.parts:
            yield ("middle" if self.head else "begin"), "\n".join(self.parts)


def _check_quotes(record: str, sep: str, file: str) -> None:
    """Quotes must enclose whole values, else their parity says nothing."""
    bare = record.replace('""', "")
    at = bare.find('"')
    while at >= 0:
        end = bare.find('"', at + 1)
        if (at and bare[at - 1] not in (sep, "\n")) or end < 0 or (end + 1 < len(bare) and bare[end + 1] not in (sep, "\r")):
            raise ValueError(f"{file}: a quote inside an unquoted value near {record[max(0, at - 20):at + 20]!r}; "
                             "read this file as one block")
        at = bare.find('"', end + 1)


def split_records(spark: SparkSession, path: str, sep: str = ",", header: list[str] | None = None) -> DataFrame:
    """(file, block, record): the text of every record of the CSV files at ``path``.

    Values may be quoted with doubled quotes inside and hold line breaks, which stay as they are.
    With ``header`` the first record of every file must name these columns, and is left out. Empty
    lines between records are none. A quote inside an unquoted value is an error. A record, not a
    file, must fit in memory.
    """
    inside, touched = _borders(_lines(spark, path))
    whole = _cut(_lines(spark, path), inside, sep, header, ends=False).select("file", "block", "record")
    if not touched:
        return whole
    # Two ends a block at most: one that ends a record (or runs through), then one that begins one.
    at = spark.createDataFrame(touched, "f string, b long")
    near = _lines(spark, path).join(F.broadcast(at), F.expr("file = f and block = b"), "left_semi")
    ends = _cut(near, inside, sep, header, ends=True)
    order = Window.partitionBy("file").orderBy("block", F.expr("kind = 'begin'"))
    joined = ends.withColumn("no", F.count_if(F.col("kind") == "begin").over(order)).groupBy("file", "no").agg(
        F.min("block").alias("block"), F.sort_array(F.collect_list(F.struct("block", "record"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["record"]), "\n")

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, record in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                _check_quotes(record, sep, file)
            yield batch

    joined = joined.select("file", "block", text.alias("record"))
    return whole.unionByName(joined.mapInArrow(checked, joined.schema))


def _cut(lines: DataFrame, inside: dict[str, set[int]], sep: str, header: list[str] | None, ends: bool) -> DataFrame:
    """(file, block, kind, record): whole records of each block, or with ``ends`` what is left of it.

    ``lines`` must lie in their order; blocks not in ``inside`` begin with a record.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, chars, first = None, [], 0, False

        def kept(found: Iterator[tuple[str, str]]) -> None:
            nonlocal chars, first
            for kind, record in found:
                opens, first = first and now.block == 0, False
                if opens:
                    record = record.removeprefix("\ufeff")
                if opens and header is not None:
                    _check_header(record, kind, header, sep, now.file)
                elif (kind == "whole") != ends and record not in ("", "\r"):
                    if '"' in record and not ends:
                        _check_quotes(record, sep, now.file)
                    rows.append((now.file, now.block, kind, record))
                    chars += len(record)

        def flush() -> pa.RecordBatch:
            types = (pa.string(), pa.int64(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                              names=["file", "block", "kind", "record"])

        for batch in batches:
            counts = pc.count_substring(batch.column(2), '"').to_pylist()
            files, blocks, values = (c.to_pylist() for c in batch.columns)
            start = 0
            while start < len(values):
                stop = start + 1
                while stop < len(values) and blocks[stop] == blocks[start] and files[stop] == files[start]:
                    stop += 1
                if now is None or (now.file, now.block) != (files[start], blocks[start]):
                    if now is not None:
                        kept(now.rest())
                    now, first = _Block(files[start], blocks[start], blocks[start] in inside.get(files[start], ())), True
                kept(now.take(values[start:stop], counts[start:stop]))
                start = stop
                if chars >= OUT_CHARS:
                    yield flush()
                    rows, chars = [], 0
        if now is not None:
            kept(now.rest())
        if rows:
            yield flush()

    return lines.mapInArrow(run, "file string, block long, kind string, record string")


def _check_header(record: str, kind: str, header: list[str], sep: str, file: str) -> None:
    if kind != "whole":
        raise ValueError(f"{file}: the header is longer than a block")
    named = next(csv_module.reader([record.rstrip("\r")], delimiter=sep), [])
    if named != header:
        raise ValueError(f"{file}: header {named} is not {header}")


def read_csv_blocks(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", strict: bool = True) -> DataFrame:
    """CSV files whose header names the columns of ``schema``, in order, read in many tasks each.

    The same rows as ``read_delimited``, but that breaks inside a value stay CR LF where they are so:
    the size of a task follows spark.sql.files.maxPartitionBytes
    and not the size of a file. The files are read twice, first for the number of quotes, and once
    more for blocks at borders inside a quoted value.
    A value that does not fit its type is an error, or NULL when ``strict`` is off.
    """
    records = split_records(spark, path, sep, schema.names)
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "lineSep": "\n",
               "maxCharsPerColumn": "-1", "mode": "FAILFAST" if strict else "PERMISSIVE"}
    body = F.regexp_replace("record", "\r$", "")
    return records.select(F.from_csv(body, _ddl(schema), options).alias("row")).select("row.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
