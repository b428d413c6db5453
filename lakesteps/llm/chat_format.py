r"""Format conversations as training examples: one per assistant turn, with all turns before it as
context and only that reply trainable.

A turn is written as ``<|im_start|>role\ntext<|im_end|>\n``. Control strings inside roles and texts
are escaped: every ``<|`` gets a backslash between its two signs, and one more if some are there
already, so nothing inside a turn can look like a mark and taking one backslash off gives the text
back. Line breaks in roles are escaped as well.

Writing the whole context into every example takes space quadratic in the turns. So context is
written out up to PAGE_TURNS turns or PAGE_CHARS characters; what lies before is stored once, as
pages, and an example names how many of them go before its own text. Conversations below that, as
nearly all are, have no pages and their examples stand alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakesteps.llm.common import slices

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
REPLY = "assistant"
PAGE_TURNS, PAGE_CHARS = 32, 1 << 16
#: Rows of one output batch, and characters it may reach.
OUT_ROWS, OUT_CHARS = 1024, 4 << 20
#: kind: example (ends with a trainable reply), page (a shared beginning, closed) or rest (turns
#: after the last reply). n_pages go before text. new_from: where turns begin that no row before
#: this one holds. Loss offsets count code points of text, end exclusive, and are null for no reply.
EXAMPLES = ("conv_id long, row long, kind string, n_pages long, text string, new_from long, "
            "loss_start long, loss_end long, whole_chars long")


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def turns_of(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    at = 0
    while at < len(text):
        head = text.index("\n", at)
        if not text.startswith(OPEN, at):
            raise ValueError(f"no turn at character {at}")
        end = text.index(CLOSE, head + 1)
        yield unescape_role(text[at + len(OPEN):head]), unescape(text[head + 1:end])
        at = end + len(CLOSE) + 1


class _Conversation:
    """The rows of one conversation, given turn by turn; holds no more than the open page."""

    def __init__(self, conv):
        self.conv, self.n, self.pages, self.page_chars = conv, 0, 0, 0
        self.parts, self.chars, self.new_from = [], 0, 0

    def _row(self, kind, loss=(None, None)):
        row = (self.conv, self.n, kind, self.pages, "".join(self.parts), self.new_from, *loss,
               self.page_chars + self.chars)
        self.n, self.new_from = self.n + 1, self.chars
        return row

    def add(self, role: str, text: str) -> Iterator[tuple]:
        if self.parts and (len(self.parts) >= PAGE_TURNS or self.chars >= PAGE_CHARS):
            yield self._row("page")
            self.pages, self.page_chars = self.pages + 1, self.page_chars + self.chars
            self.parts, self.chars, self.new_from = [], 0, 0
        body = escape(text)
        head = f"{OPEN}{escape_role(role)}\n"
        start = self.chars + len(head)
        self.parts.append(f"{head}{body}{CLOSE}\n")
        self.chars += len(self.parts[-1])
        if role == REPLY:
            yield self._row("example", (start, start + len(body)))

    def end(self) -> Iterator[tuple]:
        if self.chars > self.new_from:
            yield self._row("rest")


def _batches(rows: Iterator[tuple], schema: pa.Schema, text: int | None) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[text]) if text is not None else 0
        if len(held) >= OUT_ROWS or chars >= OUT_CHARS:
            yield _batch(held, schema)
            held, chars = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _in_arrow(df: DataFrame, rows_of, schema: str, text: int | None = None) -> DataFrame:
    """``rows_of`` takes an iterator of value lists, one per column, and yields rows."""
    out = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        inputs = (row for batch in slices(batches)
                  for row in zip(*(c.to_pylist() for c in batch.columns)))
        yield from _batches(rows_of(inputs), to_arrow_schema(out), text)

    return df.mapInArrow(run, out)


def training_examples(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                      text: str = "text") -> DataFrame:
    """The rows of EXAMPLES for conversations given as one row per turn.

    Turns follow their number; null numbers go first, equal ones follow role and text. Null roles
    and texts are empty, null conversation ids are one conversation, repeated rows are turns of
    their own, other columns are ignored. Each conversation is sorted and read in order by one task,
    which holds its open page only; turns after the last reply become a row without a loss.
    """
    rows = turns.select(
        F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")

    def expand(inputs):
        now = None
        for conv_id, _, said_by, said in inputs:
            if now is None or now.conv != conv_id:
                if now:
                    yield from now.end()
                now = _Conversation(conv_id)
            yield from now.add(said_by, said)
        if now:
            yield from now.end()

    return _in_arrow(rows, expand, EXAMPLES, text=4)


def whole_text(examples: DataFrame) -> DataFrame:
    """conv_id, row, text and loss offsets of the examples, pages put before the text.

    For corpora whose longest conversation fits a row; takes the space that pages save.
    """
    pages = examples.where("kind = 'page'").groupBy("conv_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("n_pages", "text"))), lambda p: p["text"]).alias("pages"))
    rows = examples.where("kind = 'example'").withColumnRenamed("conv_id", "c")
    rows = rows.join(pages, F.col("c").eqNullSafe(F.col("conv_id")), "left")
    before = F.array_join(F.slice(F.coalesce("pages", F.array().cast("array<string>")), F.lit(1), F.col("n_pages").cast("int")), "")
    shift = F.length(before)
    return rows.select(F.col("c").alias("conv_id"), "row", F.concat(before, "text").alias("text"),
                       (F.col("loss_start") + shift).alias("loss_start"), (F.col("loss_end") + shift).alias("loss_end"))


READ_BACK = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long, n_examples long")


def read_back(examples: DataFrame, in_order: bool = False) -> DataFrame:
    """One row per conversation, worked out from formatted rows alone: the number of turns and the
    digest of all roles and texts, of all text under the loss mask, and the length of all
    examples (a rest counts as one) with their contexts.

    Every row's new part is parsed, so each turn is read once. ``in_order`` says that the rows still
    lie as ``training_examples`` made them, which saves a shuffle; stored ones are sorted first.
    """
    rows = examples.select("conv_id", "row", "kind", "text", "new_from", "loss_start", "loss_end", "whole_chars")
    if not in_order:
        rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "row")

    def digest(inputs):
        conv = done = None
        for conv_id, _, kind, text, new_from, start, stop, whole in inputs:
            if done is None or conv_id != conv:
                if done is not None:
                    yield done()
                conv, all_turns, loss = conv_id, hashlib.sha256(), hashlib.sha256()
                n = {"turns": 0, "loss": 0, "chars": 0, "examples": 0}

                def done(conv=conv, t=all_turns, l=loss, n=n):
                    return conv, n["turns"], t.hexdigest(), n["loss"], l.hexdigest(), n["chars"], n["examples"]

            for role, said in turns_of(text[new_from:]):
                all_turns.update(f"{role}\n{said}\n".encode("utf-8"))
                n["turns"] += 1
            if start is not None:
                reply = unescape(text[start:stop])
                loss.update(reply.encode("utf-8"))
                n["loss"] += len(reply)
                n["examples"] += 1
            if kind != "page":
                n["chars"] += whole
        if done is not None:
            yield done()

    return _in_arrow(rows, digest, READ_BACK)
