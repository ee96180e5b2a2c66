"""The daily build: every subject through src, dwh and dmt."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry import schemas
from beaconry.operators.calendar import build_dim_hour
from beaconry.operators.skew import measure
from beaconry.plans import layers, marts
from beaconry.plans.dimensions import apply_changes, read_dimension
from beaconry.plans.ledger import Run, visible
from beaconry.session import scratch
from beaconry.sources.buckets import BUCKETS, current_fold, merge_buckets, read_buckets
from beaconry.sources.files import delete
from beaconry.sources.tables import (
    current_version,
    land_extract,
    overwrite_partitions,
    read_partition_range,
    read_table,
    replace_table,
)

DIMENSIONS = (*schemas.MASTER_TABLES, "hour")
# tables that a build replaces as a whole; it merges into the others
REPLACED = (("dmt", "dim_hour"),)
# versions kept: the published one stays readable while a run and its repeated step write theirs
KEPT_VERSIONS = 3


class Warehouse:
    """Table locations under one root folder, by layer.

    ``buckets`` is the number of buckets of new master tables and dimensions: enough that one fits a few tasks.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def schema(self, layer: str, table: str):
        return schemas.LAYERS[layer][table][0]

    def replace(self, layer: str, table: str, df: DataFrame) -> DataFrame:
        return replace_table(df.select(*self.schema(layer, table).names), self.path(layer, table), KEPT_VERSIONS)

    def merge(self, layer: str, table: str, rows: DataFrame) -> None:
        merge_buckets(self.spark, self.path(layer, table), self.schema(layer, table), schemas.KEYS[table], rows,
                      buckets=self.buckets, keep=KEPT_VERSIONS - 1)

    def apply(self, table: str, changes: DataFrame) -> None:
        apply_changes(self.spark, self.path("dmt", f"dim_{table}"), self.schema("dmt", f"dim_{table}"), schemas.KEYS[table],
                      changes, latest_by=["update_time"], buckets=self.buckets, keep=KEPT_VERSIONS - 1)

    def version(self, layer: str, table: str) -> int:
        return (current_version if (layer, table) in REPLACED else current_fold)(self.spark, self.path(layer, table))

    def current(self, layer: str, table: str, version: int | None = None) -> DataFrame:
        """A master table or dimension as it is now, or in a version that is still kept; no rows before the first."""
        read = read_table if (layer, table) in REPLACED else read_buckets if layer == "dwh" else read_dimension
        return read(self.spark, self.path(layer, table), self.schema(layer, table), version)

    def overwrite(self, layer: str, table: str, df: DataFrame, rebalance: bool = False) -> None:
        schema, parts = schemas.LAYERS[layer][table]
        overwrite_partitions(df.select(*schema.names), self.path(layer, table), parts, rebalance)

    def range(self, layer: str, table: str, start: str, end: str) -> DataFrame:
        schema, parts = schemas.LAYERS[layer][table]
        return read_partition_range(self.spark, self.path(layer, table), schema, parts[0], start, end)

    def dims(self, since: str | None = None) -> dict[str, DataFrame]:
        """All dimensions; with ``since`` only versions that can be valid at that day or later."""
        versions = {name: read_dimension(self.spark, self.path("dmt", f"dim_{name}"), self.schema("dmt", f"dim_{name}"), since=since)
                    for name in schemas.MASTER_TABLES}
        return {**versions, "hour": self.current("dmt", "dim_hour")}


class Published:
    """A warehouse as its readers see it: days whose tables are all in, and the master tables that belong to them.

    A build in progress, or one that was stopped, shows nothing of its days until it is published. It is a view of the
    moment it was made; make a new one to see later builds.
    """

    def __init__(self, wh: Warehouse):
        self.wh = wh
        self.ranges, self.versions = visible(wh.spark, wh.root)

    def current(self, layer: str, table: str) -> DataFrame:
        """A master table or dimension in its published version; no rows before the first."""
        return self.wh.current(layer, table, self.versions.get(f"{layer}/{table}", 0))

    def range(self, layer: str, table: str, start: str, end: str) -> DataFrame:
        """The published days of a range of partitions."""
        date_col = F.col(schemas.LAYERS[layer][table][1][0])
        shown = F.lit(False)
        for low, high in self.ranges:
            shown = shown | ((date_col >= low) & (date_col < high))
        if not self.ranges:
            return self.wh.spark.createDataFrame([], self.wh.schema(layer, table))
        return self.wh.range(layer, table, start, end).filter(shown)


def admit(wh: Warehouse, table: str, typed: DataFrame, start: str, end: str, rebalance: bool) -> None:
    """Write the typed rows dated in ``[start, end)`` to src; all others, also those of unreadable time, to quarantine.

    Partitions are replaced whole, so a stray row of an earlier day would take that day's place. The rows kept apart
    are at ``quarantine/<table>/<start>_<end>``; building the range again replaces them. Whether there are any takes a
    look at one column, so a clean extract is read once.
    """
    _, parts = schemas.LAYERS["src"][table]
    date_col = parts[0]
    inside = F.coalesce((F.col(date_col) >= start[:10]) & (F.col(date_col) < end[:10]), F.lit(False))
    wh.overwrite("src", table, typed.filter(inside), rebalance)
    outside, kept_apart = typed.filter(~inside), wh.path("quarantine", f"{table}/{start[:10]}_{end[:10]}")
    if outside.select(date_col).isEmpty():
        delete(wh.spark, kept_apart)
    else:
        outside.write.mode("overwrite").parquet(kept_apart)


def landed(wh: Warehouse, table: str) -> DataFrame:
    """The landed extract of a table, which a continued build reads instead of the extract."""
    return wh.spark.read.parquet(wh.path("tmp", table))


def build_master(wh: Warehouse, table: str, extract: DataFrame, start: str, end: str, run: Run) -> None:
    """One master table: land, type, merge, and apply to its dimension."""
    run.step(f"{table}/tmp", lambda: land_extract(extract, wh.path("tmp", table)))
    run.step(f"{table}/src", lambda: admit(
        wh, table, layers.build_src_master(landed(wh, table), table, run.now), start, end, rebalance=True))
    src = wh.range("src", table, start, end)
    run.step(f"{table}/dwh", lambda: wh.merge("dwh", table, layers.master_delta(src, start, end)))
    run.step(f"{table}/dmt", lambda: wh.apply(table, marts.dim_changes(src, table, start, end)))


def build_metric(wh: Warehouse, extract: DataFrame, start: str, end: str, run: Run, rebalance: bool = False) -> None:
    """Metric details: land, type, copy, then fact, summary and wide table for the range."""
    run.step("metric/tmp", lambda: land_extract(extract, wh.path("tmp", "metric")))
    run.step("metric/src", lambda: admit(
        wh, "metric", layers.build_src_metric(landed(wh, "metric"), run.now), start, end, rebalance))
    run.step("metric/dwh", lambda: wh.overwrite(
        "dwh", "metric", layers.build_dwh_metric(wh.range("src", "metric", start, end), start, end), rebalance))
    dims = wh.dims(start)
    measure(*dims.values())
    run.step("metric/fact", lambda: wh.overwrite(
        "dmt", "fact_metric", marts.build_fact_metric(wh.range("dwh", "metric", start, end), dims, start, end), rebalance))
    run.step("metric/sum", lambda: wh.overwrite(
        "dmt", "sum_metric_avg", marts.build_sum_metric_avg(wh.range("dmt", "fact_metric", start, end), dims, start, end), rebalance))
    run.step("metric/wide", lambda: wh.overwrite(
        "dmt", "wide_metric_avg", marts.build_wide_metric_avg(wh.range("dmt", "sum_metric_avg", start, end), dims, start, end), rebalance))


def build_day(wh: Warehouse, extracts: Mapping[str, DataFrame], start: str, end: str, now: str,
              calendar: tuple[str, str] | None = None, token: str = "", on_step: Callable[[str], None] | None = None) -> None:
    """Build the range ``[start, end)`` in subject order: hours, master tables, metrics; then show it to readers.

    ``extracts`` holds the increment of each master table and of ``metric``. The calendar
    is written once, or again when a new range is given. The master tables do not depend
    on each other, so their small jobs run side by side. Rows dated outside the range are set aside, see ``admit``.

    A build that was stopped goes on where it was when the same range is built again with the same ``token``, which
    should change with the extracts; see ``Run``. ``on_step`` is told the name of each step that was done. Readers use
    ``Published``. Intermediate tables belong to the run: they go when it ends, or when it is continued.
    """
    run = Run(wh.spark, wh.root, start, end, now, token, on_step)
    name = hashlib.sha256(f"{wh.root} {run.name}".encode()).hexdigest()[:16]
    with scratch(wh.spark, f"run-{name}"):
        _build_range(wh, extracts, start, end, run, calendar)
    tables = [*[("dwh", t) for t in schemas.MASTER_TABLES], *[("dmt", f"dim_{d}") for d in DIMENSIONS]]
    run.publish({f"{layer}/{table}": wh.version(layer, table) for layer, table in tables})


def _build_range(wh: Warehouse, extracts: Mapping[str, DataFrame], start: str, end: str, run: Run,
                 calendar: tuple[str, str] | None) -> None:
    if calendar:
        run.step("hour/dmt", lambda: wh.replace("dmt", "dim_hour", build_dim_hour(wh.spark, *calendar)))
    with ThreadPoolExecutor(len(schemas.MASTER_TABLES)) as pool:
        # each thread works in a copy of this one's context, so its intermediate tables belong to this run
        building = [pool.submit(copy_context().run, build_master, wh, table, extracts[table], start, end, run)
                    for table in schemas.MASTER_TABLES]
    for one in building:
        one.result()
    # a single day is a single partition, already written in well-sized pieces by the scan's tasks
    several_days = (date.fromisoformat(end[:10]) - date.fromisoformat(start[:10])).days > 1
    build_metric(wh, extracts["metric"], start, end, run, rebalance=several_days)
