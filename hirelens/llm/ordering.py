"""Positions in a total order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm.base import Scratch

#: monotonically_increasing_id() keeps the number of the partition above this many bits.
_ROW_BITS = 33


def positions(df: DataFrame, order: list[Column], name: str, scratch: Scratch, table: str) -> DataFrame:
    """`df` with the column `name`: 1, 2, 3... in the given order, which should have few ties.

    Rows are sorted across the cluster and numbered within their partition; only one number per partition, its
    size, is summed up in a single task. Equal rows are numbered in any order.
    """
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = scratch.keep(sorted_, table).withColumn("_part", F.shiftright("_at", _ROW_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # One row per partition of the sort: small for any amount of data.
    index = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + index + 1).drop("_part", "_at", "_before")
