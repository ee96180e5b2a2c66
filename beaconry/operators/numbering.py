"""Contiguous numbering without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.session import materialize

SLOT = "__slot"
# row slots are (partition << 33) + position, as monotonically_increasing_id lays them out
POSITION_BITS = 33


def max_key(dim: DataFrame, name: str = "dwid") -> DataFrame:
    """One row holding the largest key so far, 0 for an empty table."""
    return dim.agg(F.coalesce(F.max(name), F.lit(0)).cast("long").alias("max_id"))


def number_rows(df: DataFrame, order: Sequence[str], start: int | Column = 0, name: str = "dwid") -> DataFrame:
    """``row_number() over (order by ...) + start`` for an order that is unique per row.

    Rows are range-partitioned and sorted, each partition numbers its own rows, and the
    written result is shifted by the sizes of the partitions before it. Only those
    sizes, one per partition, visit the driver. Writing first fixes the ranges, so a
    rerun task cannot see other boundaries than the counting pass did.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    slotted = materialize(ordered.withColumn(SLOT, F.monotonically_increasing_id()), "numbering")
    part = F.shiftright(SLOT, POSITION_BITS)
    sizes = {r["part"]: r["n"] for r in slotted.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = sorted(sizes)
    before = dict(zip(parts, accumulate([0] + [sizes[p] for p in parts[:-1]])))
    offsets = F.lit([before.get(p, 0) for p in range(max(parts, default=0) + 1)])
    position = F.col(SLOT) - F.shiftleft(part, POSITION_BITS)
    start = F.lit(start) if isinstance(start, int) else start
    number = start + F.element_at(offsets, part.cast("int") + F.lit(1)) + position + F.lit(1)
    return slotted.select(number.cast("long").alias(name), *df.columns)


assign_dwid = number_rows
