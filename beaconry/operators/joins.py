"""Dimension joins of the star schema and stream enrichment lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.functions.times import day_start, hour_start
from beaconry.operators.skew import part_of, sized_join

FROM, TO = "__valid_from", "__valid_to"


def valid_at(ts: Column, valid_from: str = FROM, valid_to: str = TO) -> Column:
    """The version covers the instant: from is included, to is not, an open end covers everything after."""
    return (ts >= F.col(valid_from)) & ((ts < F.col(valid_to)) | F.col(valid_to).isNull())


def _versions(dim: DataFrame, on: Mapping[str, str], take: Mapping[str, str]) -> DataFrame:
    """The dimension reduced to join keys (under the fact's names), taken columns and validity."""
    columns = [f"`{d}` AS `{f}`" for f, d in on.items()] + [f"`{s}` AS `{n}`" for n, s in take.items()]
    return part_of(dim.selectExpr(*columns, f"valid_from AS {FROM}", f"valid_to AS {TO}"), dim)


def within_range(dim: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Only the versions that can cover a time in ``[start, end)``."""
    covering = dim
    if end is not None:
        covering = covering.filter(F.col("valid_from") < F.to_timestamp(F.lit(end)))
    if start is not None:
        covering = covering.filter(F.col("valid_to").isNull() | (F.col("valid_to") > F.to_timestamp(F.lit(start))))
    return part_of(covering, dim)


def pit_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    ts: str = "timestamp",
    how: str = "inner",
    limit: int | None = None,
) -> DataFrame:
    """Attach columns of the dimension version that was valid at the event time.

    ``on`` maps fact columns to dimension columns, ``take`` maps result names to
    dimension columns; no other dimension column is read.
    """
    joined = sized_join(fact, _versions(dim, on, take), list(on), how, valid_at(F.col(ts)), limit)
    return joined.drop(FROM, TO)


def asof_date_join(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    date_col: str = "creation_date",
    limit: int | None = None,
) -> DataFrame:
    """Attach columns of the version that was valid at the start of the row's day."""
    joined = sized_join(df, _versions(dim, on, take), list(on), "inner", valid_at(day_start(date_col)), limit=limit)
    return joined.drop(FROM, TO)


def lift_dimension(inner: DataFrame, outer: DataFrame, on: Mapping[str, str], take: Mapping[str, str],
                   limit: int | None = None) -> DataFrame:
    """Attach an indirect dimension to a direct one, version by version.

    Each result row is valid where both versions are, so one point-in-time join of the
    facts against it equals two joins against the parts.
    """
    overlap = (F.col("valid_from") < F.coalesce(F.col(TO), F.to_timestamp(F.lit("9999-12-31")))) & (
        F.col(FROM) < F.coalesce(F.col("valid_to"), F.to_timestamp(F.lit("9999-12-31")))
    )
    joined = sized_join(inner, _versions(outer, on, take), list(on), "inner", overlap, limit=limit)
    return (
        joined.withColumn("valid_from", F.greatest("valid_from", FROM))
        .withColumn("valid_to", F.least("valid_to", TO))
        .drop(FROM, TO)
    )


def with_hour_key(fact: DataFrame, dim_hour: DataFrame, ts: str = "timestamp", limit: int | None = None) -> DataFrame:
    """Attach the calendar key of the hour; rows outside the calendar are dropped."""
    hours = part_of(dim_hour.selectExpr("db_hour AS __hour", "dwid AS hour_dwid"), dim_hour)
    return sized_join(fact.withColumn("__hour", hour_start(ts)), hours, ["__hour"], limit=limit).drop("__hour")


def attach(df: DataFrame, dim: DataFrame, on: Mapping[str, str], take: Mapping[str, str], how: str = "inner",
           limit: int | None = None) -> DataFrame:
    """Attach columns of a dimension by plain key equality."""
    columns = [f"`{d}` AS `{f}`" for f, d in on.items()] + [f"`{s}` AS `{n}`" for n, s in take.items()]
    side = part_of(dim.selectExpr(*columns), dim)
    return sized_join(df, side, list(on), how, limit=limit)


# result name -> dimension column, for the wide table
APP_COLUMNS = {"app_name": "name", "app_description": "description", "app_version": "version"}
SERVER_COLUMNS = {"server_hostname": "hostname", "server_cpu_cores": "cpu_cores", "server_memory": "memory"}
METRIC_COLUMNS = {"metric_name": "name", "metric_description": "description", "metric_category": "category"}
THRESHOLD_COLUMNS = {"amber_threshold": "amber_threshold", "red_threshold": "red_threshold"}
HOUR_COLUMNS = ("db_date", "db_hour", "year", "month", "day", "hour", "quarter", "week",
                "day_name", "month_name", "weekend_flag")


def star_join(summary: DataFrame, dims: Mapping[str, DataFrame], limit: int | None = None) -> DataFrame:
    """Flatten app, server, metric index and hour onto a summary by surrogate key."""
    out = attach(summary, dims["app"], {"app_dwid": "dwid"}, APP_COLUMNS, limit=limit)
    out = attach(out, dims["server"], {"server_dwid": "dwid"}, {**SERVER_COLUMNS, "server_id": "id"}, limit=limit)
    out = attach(out, dims["metric_index"], {"metric_index_dwid": "dwid"}, METRIC_COLUMNS, limit=limit)
    return attach(out, dims["hour"], {"hour_dwid": "dwid"}, {c: c for c in HOUR_COLUMNS}, limit=limit)


def threshold_join(starred: DataFrame, dim_threshold: DataFrame, compat: bool = False, limit: int | None = None) -> DataFrame:
    """Attach thresholds by the key the summary was rated with.

    ``compat`` joins every version of the (server, metric) threshold instead, so a
    summary row repeats once per version.
    """
    if not compat:
        return attach(starred, dim_threshold, {"metric_threshold_dwid": "dwid"}, THRESHOLD_COLUMNS, limit=limit)
    on = {"server_id": "server_id", "metric_name": "metric_name"}
    take = {"metric_threshold_dwid": "dwid", **THRESHOLD_COLUMNS}
    return attach(starred.drop("metric_threshold_dwid"), dim_threshold, on, take, limit=limit)


def unmatched_facts(fact: DataFrame, dim: DataFrame, on: Mapping[str, str], ts: str = "timestamp",
                    limit: int | None = None) -> DataFrame:
    """Facts the point-in-time join drops because no version covers them."""
    return sized_join(fact, _versions(dim, on, {}), list(on), "left_anti", valid_at(F.col(ts)), limit=limit)


def enrich_server(df: DataFrame, servers: DataFrame, take: Sequence[str] = ("server_id",), how: str = "left",
                  limit: int | None = None) -> DataFrame:
    """Look up servers by hostname; with a left join an unknown host keeps NULLs for the caller to quarantine.

    Works on a stream too: the server side is measured once, when the query is built.
    """
    side = part_of(servers.select("hostname", *take), servers)
    return sized_join(df, side, ["hostname"], how, limit=limit)


def enrich_alert(df: DataFrame, alert_index: DataFrame, how: str = "left", limit: int | None = None) -> DataFrame:
    """Look up alert type id and severity by message."""
    side = part_of(alert_index.select(F.col("name").alias("message"), F.col("id").alias("alert_id"), "severity"), alert_index)
    return sized_join(df, side, ["message"], how, limit=limit)


def delete_keys(df: DataFrame, keys_df: DataFrame, on: Sequence[str], limit: int | None = None) -> DataFrame:
    """Rows whose key is not listed."""
    return sized_join(df, keys_df.select(*on).distinct(), list(on), "left_anti", limit=limit)
