"""Dense keys and dimension lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakesteps.session import materialize

# monotonically_increasing_id holds the partition above bit 33 and the row number below it.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def dense_key(
    df: DataFrame, order_by: Sequence[Column | str], name: str, ties: bool = False
) -> DataFrame:
    """Number all rows 1..N in ``order_by``, without bringing them into one task.

    The rows are range-partitioned and sorted, each gets its place within its partition, and the
    result is written once so that the places can no longer move. The counts of the partitions
    (one row each, so their number is bounded by the partitions) then give every partition its
    offset.

    ``order_by`` must leave no ties, or ``ties`` must be set: rows that tie, such as copies of one
    row, are then first given a written running number, so that even a third of the table being
    copies is spread over many tasks.
    """
    columns = df.columns
    order = [F.col(o) if isinstance(o, str) else o for o in order_by]
    if ties:
        df = materialize(df.withColumn("_tie", F.monotonically_increasing_id()), "dense-key-ties")
        order.append(F.col("_tie"))
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = materialize(placed, "dense-key")
    part = F.shiftright("_place", _ROW_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    key = F.col("_offset") + F.col("_place").bitwiseAND(F.lit(_ROW_MASK)) + 1
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(key.cast("bigint").alias(name), *columns)
    )


def lookup_dim(
    df: DataFrame, dim: DataFrame, on: Sequence[str] | Column, *take: str
) -> DataFrame:
    """Left join to a dimension, taking only the named columns from it.

    There is no broadcast hint: Spark broadcasts the dimension when its measured size allows it
    and otherwise sorts and splits skewed partitions.
    """
    if isinstance(on, Column):
        return df.join(dim, on, "left")
    return df.join(dim.select(*on, *take), list(on), "left")
