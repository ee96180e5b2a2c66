"""Hourly means, incident registries and nested master documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.operators.merge import latest_per_key
from beaconry.operators.skew import sized_join


def rounded_mean(value: str) -> Column:
    """Mean rounded half up to an integer."""
    return F.round(F.avg(value)).cast("int")


def hourly_mean(fact: DataFrame, keys: Sequence[str], value: str = "value", grain: str | None = None,
                ts: str = "timestamp", name: str = "avg_value") -> DataFrame:
    """Rounded mean per key group, optionally also per ``grain`` (hour, day, ...) of a timestamp."""
    groups = [F.col(k) for k in keys]
    if grain:
        groups.append(F.date_trunc(grain, ts).alias(f"{grain}_start"))
    return fact.groupBy(*groups).agg(rounded_mean(value).alias(name))


def incident_registry(alerts: DataFrame) -> DataFrame:
    """One row per (server, alert type, incident time), telling whether it was seen opened and closed."""
    return alerts.groupBy("server_id", "alert_id", "incident_ts").agg(
        F.bool_or(F.col("status") == "OPEN").alias("opened"),
        F.bool_or(F.col("status") == "CLOSED").alias("closed"),
    )


def merge_registries(*registries: DataFrame) -> DataFrame:
    """Combine registries flag by flag; order and repetition do not matter."""
    every = registries[0]
    for other in registries[1:]:
        every = every.unionByName(other)
    return every.groupBy("server_id", "alert_id", "incident_ts").agg(
        F.bool_or("opened").alias("opened"), F.bool_or("closed").alias("closed")
    )


def expire_incidents(registry: DataFrame, as_of: int | Column, ttl: int) -> DataFrame:
    """Only the incidents younger than ``ttl`` seconds at ``as_of``."""
    as_of = F.lit(as_of) if isinstance(as_of, int) else as_of
    return registry.filter(as_of - F.col("incident_ts") < F.lit(ttl))


def server_severity(registry: DataFrame, alert_index: DataFrame, limit: int | None = None) -> DataFrame:
    """Highest severity among the incidents of a server that are opened and not closed, else 0."""
    levels = alert_index.select(F.col("id").alias("alert_id"), "severity")
    rated = sized_join(registry, levels, ["alert_id"], "left", limit=limit)
    pending = F.when(F.col("opened") & ~F.col("closed"), F.col("severity"))
    return rated.groupBy("server_id").agg(F.coalesce(F.max(pending), F.lit(0)).cast("int").alias("severity"))


def nest_thresholds(threshold: DataFrame) -> DataFrame:
    """Per server a map from metric name to its threshold entry.

    Duplicate (server, metric) rows are reduced to the newest first, so an entry list is
    no longer than the number of metric kinds.
    """
    current = latest_per_key(threshold, ["server_id", "metric_name"], [F.desc("update_time")])
    entry = F.struct(
        F.col("red_threshold").alias("redThreshold"),
        F.col("amber_threshold").alias("amberThreshold"),
        F.unix_millis("creation_time").alias("creationTime"),
        F.unix_millis("update_time").alias("updateTime"),
    )
    return current.groupBy("server_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("metric_name", entry)))).alias("metric_thresholds")
    )


def servers_by_app(server: DataFrame) -> DataFrame:
    """The set of servers of each app as (app, server) rows, each once.

    Rows, because an app may own any number of servers; a reader that wants one app's list filters and sorts.
    """
    return server.select("app_id", F.col("id").alias("server_id")).distinct()
