"""Polling a table at regular ticks, as a stream that goes on where it stopped."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from beaconry.functions.times import ceil_tick

TICKS = "beaconry_ticks"


class Span(InputPartition):
    """The ticks after ``low`` up to ``high``, in epoch seconds."""

    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class TickReader(DataSourceStreamReader):
    """Offsets are ticks. What lies between two offsets is one row, so a long pause costs no more than a short one."""

    def __init__(self, options: dict[str, str]):
        self.step = int(options.get("step", 5))
        self.start = int(options["start"])
        self.until = int(options["until"]) if options.get("until") else None

    def _nominal(self, at: int) -> int:
        return at - at % self.step

    def initialOffset(self) -> dict[str, int]:
        return {"tick": self._nominal(self.start)}

    def latestOffset(self) -> dict[str, int]:
        now = int(time.time())
        return {"tick": max(self._nominal(self.start), self._nominal(now if self.until is None else min(now, self.until)))}

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> list[Span]:
        return [Span(start["tick"], end["tick"])] if end["tick"] > start["tick"] else []

    def read(self, partition: Span) -> Iterator[tuple[int, int]]:
        yield partition.low, partition.high


class TickSource(DataSource):
    """Nominal ticks as a stream of spans ``(low, high]``. Options: ``start``, ``step`` and ``until`` in epoch seconds."""

    @classmethod
    def name(cls) -> str:
        return TICKS

    def schema(self) -> str:
        return "low long, high long"

    def streamReader(self, schema) -> TickReader:
        return TickReader(self.options)


def ticks(spark: SparkSession, start: int, step: int = 5, until: int | None = None) -> DataFrame:
    """The ticks after ``start`` as a stream; it never goes beyond the clock, nor beyond ``until``."""
    spark.dataSource.register(TickSource)
    reader = spark.readStream.format(TICKS).option("start", str(start)).option("step", str(step))
    return (reader if until is None else reader.option("until", str(until))).load()


def wave_rows(table: DataFrame, ts_col: str, low: int, high: int, step: int, offset: int, arrival_col: str | None = None) -> DataFrame:
    """What the reads of one wave at the ticks in ``(low, high]`` return together.

    The windows of successive ticks adjoin, so one range filter reads them, which reaches the scan. ``read_tick`` is the
    tick a row is read at. With ``arrival_col`` a row counts only if it was there by then, which makes the result the
    same however late the poll runs.
    """
    bounds = [F.timestamp_seconds(F.lit(at - offset)) for at in (low, high)]
    rows = table.filter((F.col(ts_col) > bounds[0]) & (F.col(ts_col) <= bounds[1]))
    rows = rows.withColumn("wave_offset", F.lit(offset)).withColumn("read_tick", ceil_tick(ts_col, step, offset))
    if arrival_col:
        rows = rows.filter(F.unix_micros(F.col(arrival_col)) <= F.col("read_tick") * F.lit(1_000_000))
    return rows


def poll(
    spark: SparkSession,
    table: DataFrame | Callable[[], DataFrame],
    ts_col: str,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    start: int,
    step: int = 5,
    offsets: Sequence[int] = (0, 60),
    until: int | None = None,
    arrival_col: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Read a table at every tick in several waves and hand the rows of a batch of ticks to the sink.

    Wave ``o`` reads ``(t - o - step, t - o]`` at tick ``t``. Which ticks are done is in the checkpoint: a query that was
    stopped, or that overran its ticks, reads the ones it missed next, and each tick's windows belong to one batch. A
    batch that failed half-way runs again over the same ticks, so a sink that replaces a batch by its number takes every
    row once per wave. Rows that several waves see are there several times; ``dedup_stream`` removes them. A table
    given as a function is read anew for every batch.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        span = batch.agg(F.min("low").alias("low"), F.max("high").alias("high")).first()
        if span.high is None:
            return
        now = table() if callable(table) else table
        waves = [wave_rows(now, ts_col, span.low, span.high, step, o, arrival_col) for o in offsets]
        sink(reduce(DataFrame.unionByName, waves), batch_id)

    writer = ticks(spark, start, step, until).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
