"""Master-data access as table operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.operators.aggregates import nest_thresholds
from beaconry.operators.joins import delete_keys
from beaconry.operators.merge import merge_latest
from beaconry.operators.skew import part_of, sized_join

__all__ = ["delete_keys", "list_all", "lookup_by_id", "lookup_by_name", "metric_thresholds", "preview",
           "server_documents", "server_snapshot", "threshold_of", "upsert"]


def lookup_by_id(dim: DataFrame, keys_df: DataFrame, on: str = "id", limit: int | None = None) -> DataFrame:
    """Rows whose id is asked for; repeated requests are reduced before the join."""
    return sized_join(dim, keys_df.select(on).distinct(), [on], "left_semi", limit=limit)


def lookup_by_name(dim: DataFrame, names_df: DataFrame, col: str, limit: int | None = None) -> DataFrame:
    """Rows whose secondary key (app name, hostname, metric name, alert name) is asked for."""
    return lookup_by_id(dim, names_df, col, limit)


def list_all(dim: DataFrame) -> DataFrame:
    return dim


def preview(df: DataFrame, n: int, order_cols: Sequence[str]) -> DataFrame:
    """The first ``n`` rows under an order; Spark keeps n per task and merges those."""
    return df.orderBy(*order_cols).limit(n)


def upsert(dim: DataFrame, delta: DataFrame, keys: Sequence[str], limit: int | None = None) -> DataFrame:
    return merge_latest(dim, delta, keys, full_is_unique=True, limit=limit)


def server_snapshot(server: DataFrame, threshold: DataFrame, limit: int | None = None) -> DataFrame:
    """Servers with their thresholds nested; a server without thresholds has NULL."""
    nested = nest_thresholds(threshold).withColumnRenamed("server_id", "id")
    return sized_join(server, nested, ["id"], "left", limit=limit)


def server_documents(snapshot: DataFrame) -> DataFrame:
    """The snapshot as JSON documents, one per server."""
    return snapshot.select(
        "id",
        F.to_json(F.struct(
            "id", "hostname", F.col("cpu_cores").alias("cpuCores"), "memory", F.col("app_id").alias("appId"),
            F.col("metric_thresholds").alias("metricThresholds"),
            F.unix_millis("creation_time").alias("creationTime"), F.unix_millis("update_time").alias("updateTime"),
        )).alias("document"),
    )


def threshold_of(name: str | Column, thresholds: str = "metric_thresholds") -> Column:
    """The nested entry of one metric, NULL where the server has none."""
    return F.try_element_at(F.col(thresholds), F.lit(name) if isinstance(name, str) else name)


def all_thresholds(server: DataFrame, threshold: DataFrame, limit: int | None = None) -> DataFrame:
    """One narrow row per host and metric: server id, host, metric and both thresholds."""
    wanted = part_of(threshold.select(
        F.col("server_id").alias("id"), "metric_name", "amber_threshold", "red_threshold"), threshold)
    return sized_join(wanted, server.select("id", "hostname"), ["id"], limit=limit).withColumnRenamed("id", "server_id")


def metric_thresholds(server: DataFrame, threshold: DataFrame, metric: str, limit: int | None = None) -> DataFrame:
    """One narrow row per host for the metric a stream evaluates: server id and both thresholds."""
    name = metric.replace("_", ".")
    wanted = part_of(threshold.filter(F.col("metric_name") == name).select(
        F.col("server_id").alias("id"), "amber_threshold", "red_threshold"), threshold)
    hosts = server.select("id", "hostname")
    return sized_join(hosts, wanted, ["id"], limit=limit).withColumnRenamed("id", "server_id")
