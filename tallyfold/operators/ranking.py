"""Rank over a whole table without a window in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.sources.scratch import handed_over

_ROW_BITS = 33  # monotonically_increasing_id has the partition above them and the row below


def total_rank(df: DataFrame, order: Sequence[str | Column], name: str = "rank") -> DataFrame:
    """Adds 1, 2, 3... in the given order over all rows.

    Rows are dealt by ranges of the order and sorted there, so every task holds one range; the sorted ranges are
    written once, their rows counted, and each range starts behind the rows of those before it. The window that adds
    up the counts has one row for a range. Rows that tie in ``order`` get ranks of their own in no stated order, so
    give an order without ties where the rank has to be reproducible.
    """
    at, part = "_at", "_part"
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = handed_over(ranges.withColumn(at, F.monotonically_increasing_id())).withColumn(part, F.shiftright(at, _ROW_BITS))
    counts = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(part, (F.sum("_n").over(Window.orderBy(part)) - F.col("_n")).alias("_before"))
    own = F.col(at).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # one row for a range: as many as the shuffle has partitions
    ranked = placed.join(F.broadcast(before), part)
    return ranked.select(*df.columns, (F.col("_before") + own + 1).alias(name))
