"""Small helpers shared by the training-text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

#: Bytes of text a Python task works on at once. Spark bounds what it sends by
#: spark.sql.execution.arrow.maxBytesPerBatch; no setting of the session is changed here.
BATCH_BYTES = 8 << 20
#: White space as the word rules define it (code points 32 and 9 to 13).
BLANKS = " \t\n\x0b\x0c\r"


def free_name(df: DataFrame, base: str) -> str:
    """A column name ``df`` does not have, also when case is ignored."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that each holds about ``size`` bytes of ``column``, or one row."""
    for batch in batches:
        start, held = 0, 0
        for i, length in enumerate(pc.binary_length(batch.column(column)).fill_null(0).to_pylist()):
            if i > start and held + length > size:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += length
        if start < batch.num_rows:
            yield batch.slice(start)


def per_text(df: DataFrame, work: Callable[[list[str]], list[tuple]], schema: str,
             text: str = "text") -> DataFrame:
    """Append columns worked out from each whole text.

    ``work`` gets a list of texts (null: empty) and returns one tuple per text, in the order of
    ``schema``. The other columns of ``df`` pass through unchanged; the text itself does not.
    """
    added = df.sparkSession.createDataFrame([], schema).schema
    keep = [c for c in df.columns if c != text]
    out_schema = df.select(*(f"`{c}`" for c in keep)).schema
    for f in added:
        out_schema.add(f)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(added)
        for batch in slices(batches, text):
            texts = [t or "" for t in batch.column(text).to_pylist()]
            rows = list(zip(*work(texts))) or [()] * len(added)
            arrays = [batch.column(c) for c in keep]
            arrays += [pa.array(v, type=f.type) for v, f in zip(rows, arrow)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *added.names])

    return df.mapInArrow(run, out_schema)
