"""Dimensions, the metric fact, its hourly summary and the wide table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry import schemas
from beaconry.functions.rating import gen_rag
from beaconry.operators.aggregates import hourly_mean
from beaconry.operators.joins import (
    asof_date_join,
    lift_dimension,
    pit_join,
    star_join,
    threshold_join,
    with_hour_key,
    within_range,
)
from beaconry.operators.scd2 import change_set, scd2_apply
from beaconry.operators.skew import measure
from beaconry.sources.extract import date_range

FACT_DIMS = ("server", "app", "metric_index", "hour")
SUMMARY_DIMS = ("server", "metric_index", "metric_threshold")
WIDE_DIMS = ("app", "server", "metric_index", "hour", "metric_threshold")
SUMMARY_KEYS = ("creation_date", "app_dwid", "server_dwid", "metric_index_dwid", "hour_dwid")


def _measure_dims(dims: Mapping[str, DataFrame], names: Sequence[str], limit: int | None) -> None:
    """Learn the sizes of all dimensions of a build in one job."""
    if limit is None or limit > 0:
        measure(*[dims[n] for n in names])


def dim_changes(src: DataFrame, table: str, start: str, end: str) -> DataFrame:
    """The changes of a range of days, with what tells the last of a day."""
    return change_set(src, [*schemas.ATTRIBUTES[table].names, "update_time"], start, end)


def build_dim(dim: DataFrame, src: DataFrame, table: str, start: str, end: str, compat: bool = False,
              limit: int | None = None) -> DataFrame:
    """A dimension after the increments of a range of days."""
    if compat:
        changes = change_set(src, schemas.ATTRIBUTES[table].names, start, end)
        return scd2_apply(dim, changes, schemas.KEYS[table], compat=True, limit=limit)
    return scd2_apply(dim, dim_changes(src, table, start, end), schemas.KEYS[table], latest_by=["update_time"], limit=limit)


def build_fact_metric(metric: DataFrame, dims: Mapping[str, DataFrame], start: str, end: str,
                      limit: int | None = None) -> DataFrame:
    """Metric events of ``[start, end)`` with the surrogate keys valid at their time.

    The app is attached to the server dimension first, version by version, so that the
    events are joined once by hostname instead of once per level. Dimension versions
    outside the date range are left out first.
    """
    _measure_dims(dims, FACT_DIMS, limit)
    events = date_range(metric, "creation_date", start, end)
    servers, apps, kinds = (within_range(dims[d], start, end) for d in ("server", "app", "metric_index"))
    hosts = lift_dimension(
        servers.select("dwid", "hostname", "app_id", "valid_from", "valid_to"), apps,
        {"app_id": "id"}, {"app_dwid": "dwid"}, limit=limit)
    fact = pit_join(events, hosts, {"hostname": "hostname"}, {"server_dwid": "dwid", "app_dwid": "app_dwid"},
                    limit=limit)
    fact = pit_join(fact, kinds, {"name": "name"}, {"metric_index_dwid": "dwid"}, limit=limit)
    return with_hour_key(fact, dims["hour"], limit=limit).select(*schemas.FACT_METRIC.names)


def build_sum_metric_avg(fact: DataFrame, dims: Mapping[str, DataFrame], start: str, end: str,
                         limit: int | None = None) -> DataFrame:
    """Hourly mean per app, server and metric, rated against the thresholds of its day."""
    _measure_dims(dims, SUMMARY_DIMS, limit)
    means = hourly_mean(date_range(fact, "creation_date", start, end), SUMMARY_KEYS)
    servers, kinds, thresholds = (within_range(dims[d], start, end) for d in ("server", "metric_index", "metric_threshold"))
    out = asof_date_join(means, servers, {"server_dwid": "dwid"}, {"server_id": "id"}, limit=limit)
    out = asof_date_join(out, kinds, {"metric_index_dwid": "dwid"}, {"metric_name": "name"}, limit=limit)
    out = asof_date_join(
        out, thresholds, {"server_id": "server_id", "metric_name": "metric_name"},
        {"metric_threshold_dwid": "dwid", "amber_threshold": "amber_threshold", "red_threshold": "red_threshold"},
        limit=limit)
    rag = gen_rag("avg_value", "amber_threshold", "red_threshold")
    return out.withColumn("rag", rag).select(*schemas.SUM_METRIC_AVG.names)


def build_wide_metric_avg(summary: DataFrame, dims: Mapping[str, DataFrame], start: str, end: str,
                          compat: bool = False, limit: int | None = None) -> DataFrame:
    """The summary with all its dimensions flattened.

    ``compat`` includes the end date and joins all versions of a threshold.
    """
    _measure_dims(dims, WIDE_DIMS, limit)
    rows = date_range(summary, "creation_date", start, end, "both" if compat else "left")
    starred = star_join(rows, dims, limit=limit)
    wide = threshold_join(starred, dims["metric_threshold"], compat, limit=limit)
    return wide.withColumn("avg_value", F.col("avg_value").cast("long")).select(*schemas.WIDE_METRIC_AVG.names)
