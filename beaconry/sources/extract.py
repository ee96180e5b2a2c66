"""Incremental reads: time ranges, trailing windows, ticks and repeated waves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.functions.times import ceil_tick, epoch_seconds, seconds_before

CLOSED = ("both", "left", "right", "neither")


def between(c: Column, low: Column, high: Column, closed: str) -> Column:
    if closed not in CLOSED:
        raise ValueError(f"closed must be one of {CLOSED}")
    above = c >= low if closed in ("both", "left") else c > low
    below = c <= high if closed in ("both", "right") else c < high
    return above & below


def incremental_extract(df: DataFrame, ts_col: str, start: str, end: str, closed: str = "left") -> DataFrame:
    """Rows of a time range. The bounds are literals, so the filter reaches the scan.

    Half-open by default: with ``closed="both"`` a row at exactly ``end`` is extracted
    again by the next range.
    """
    low, high = (F.to_timestamp(F.lit(x)) for x in (start, end))
    return df.filter(between(F.col(ts_col), low, high, closed))


def trailing_window(df: DataFrame, ts_col: str, at: str, seconds: int = 5, closed: str = "right") -> DataFrame:
    """Rows of the ``seconds`` before ``at``; right-closed unless told otherwise."""
    high = F.to_timestamp(F.lit(at))
    return df.filter(between(F.col(ts_col), seconds_before(high, seconds), high, closed))


def date_range(df: DataFrame, col: str, start: str, end: str, closed: str = "left") -> DataFrame:
    """Rows of a range of date strings; on a partition column this prunes directories."""
    return df.filter(between(F.col(col), F.lit(start), F.lit(end), closed))


def assign_tick(df: DataFrame, ts_col: str, step: int = 5, name: str = "tick") -> DataFrame:
    """Label each row with the nominal tick that reads it, ``tick - step < ts <= tick``, in epoch seconds."""
    return df.withColumn(name, ceil_tick(ts_col, step))


def multi_wave_extract(
    df: DataFrame,
    ts_col: str,
    arrival_col: str,
    step: int = 5,
    offsets: Sequence[int] = (0, 60),
) -> DataFrame:
    """All rows that periodic reads would return when every tick reads several shifted windows.

    The wave with offset ``o`` reads ``(t - o - step, t - o]`` at each tick ``t``, so a row
    is read once per wave, at the tick that closes ``ts + o``, provided it has
    arrived by then. The read tick is computed from the row, without joining ticks.
    A row seen by several waves appears several times; remove those with ``dedup_stream``.
    """
    waves = df.withColumn("wave_offset", F.explode(F.array(*[F.lit(o) for o in offsets])))
    waves = waves.withColumn("read_tick", ceil_tick(ts_col, step, F.col("wave_offset")))
    return waves.filter(F.unix_micros(F.col(arrival_col)) <= F.col("read_tick") * F.lit(1_000_000))


def single_wave(df: DataFrame, ts_col: str, arrival_col: str, step: int = 5, offset: int = 0) -> DataFrame:
    return multi_wave_extract(df, ts_col, arrival_col, step, (offset,))


def union_waves(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other)
    return first


def with_epoch(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Replace a timestamp by epoch seconds, as polled rows are published."""
    return df.withColumn(ts_col, epoch_seconds(ts_col))
