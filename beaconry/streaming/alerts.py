"""Incidents with their servers and types: registries, ratings, and the sink of what a stream changes."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry import schemas
from beaconry.functions.times import align_tick
from beaconry.operators.aggregates import incident_registry, server_severity
from beaconry.operators.joins import enrich_alert, enrich_server
from beaconry.operators.skew import measure
from beaconry.streaming.incidents import HOST, INCIDENT
from beaconry.streaming.sinks import Sink, read_upserts

ALERT_SOURCE = "alert"
REGISTRY_KEYS = ["server_id", "alert_id", "incident_ts"]
# fixed value: seconds an incident stays registered
TIME_TO_LIVE = 60
REGISTRY = schemas.struct(
    server_id=schemas.LONG, alert_id=schemas.LONG, incident_ts=schemas.LONG, opened=schemas.BOOL, closed=schemas.BOOL)
LIVE_REGISTRY = schemas.extend(REGISTRY, live=schemas.BOOL)


def identify(alerts: DataFrame, servers: DataFrame, alert_index: DataFrame, limit: int | None = None) -> DataFrame:
    """Alerts with server id, alert type id and incident time; unknown hosts and messages keep NULL ids."""
    known = enrich_alert(enrich_server(alerts, servers, limit=limit), alert_index, limit=limit)
    return known.withColumn("incident_ts", F.unix_timestamp("timestamp"))


def is_known() -> Column:
    return F.col("server_id").isNotNull() & F.col("alert_id").isNotNull()


def evaluate_alerts(registry: DataFrame, alert_index: DataFrame, as_of: int | Column, limit: int | None = None) -> DataFrame:
    """The alert state of each registered server at ``as_of``, stamped on the common tick grid."""
    as_of = F.lit(as_of).cast("long") if isinstance(as_of, int) else as_of
    return server_severity(registry, alert_index, limit).select(
        "server_id", align_tick(as_of).cast("long").alias("timestamp"), F.lit(ALERT_SOURCE).alias("src_type"), "severity")


def registry_updates(alerts: DataFrame, servers: DataFrame, alert_index: DataFrame, watermark: str | None = None,
                     limit: int | None = None) -> DataFrame:
    """The registry as a streaming aggregation, for hosts with more incidents than one state entry should hold.

    Run in update mode into a sink keyed by (server, alert type, incident time): the state
    store then carries the flags and a batch emits only the incidents it changed. Without
    a watermark no alert is ever too late, but nothing is forgotten either. A watermark
    bounds the state, at the price that a CLOSED arriving later than it is
    dropped and leaves its incident open.
    """
    if watermark:
        alerts = alerts.withWatermark("timestamp", watermark)
    known = identify(alerts, servers, alert_index, limit).filter(is_known())
    if not watermark:
        return incident_registry(known)
    # grouping by the event time itself is what lets the watermark drop old state
    folded = known.groupBy("server_id", "alert_id", "timestamp").agg(
        F.bool_or(F.col("status") == "OPEN").alias("opened"), F.bool_or(F.col("status") == "CLOSED").alias("closed"))
    return folded.select(*REGISTRY.names[:2], F.unix_timestamp("timestamp").alias("incident_ts"), "opened", "closed")


def change_sink(server: Callable[[], DataFrame], alert_index: Callable[[], DataFrame], registry: Sink, states: Sink) -> Sink:
    """A micro-batch handler for ``incident_changes``: writes changed incidents and rates the hosts concerned.

    Only what changed is written, whatever the size of the registry. Servers and alert types are those of the moment;
    hosts and messages that are not listed are left out (their alerts go to quarantine where raw alerts are kept). A
    change of the lists counts for a host at its next change.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            # all hosts at once; a sink first looks for one row, and would fold the first task's hosts while no other runs
            batch.count()
            servers, index = server().withColumnRenamed("id", "server_id"), alert_index()
            measure(servers, index)
            changed = enrich_alert(enrich_server(batch.filter(F.col("kind") == INCIDENT), servers), index)
            hosts = enrich_server(batch.filter(F.col("kind") == HOST).drop("message"), servers)
            open_ = hosts.filter(F.col("server_id").isNotNull()).select("server_id", "as_of", F.explode_outer("pending").alias("message"))
            # a host has one row in a batch
            rated = enrich_alert(open_, index).groupBy("server_id", "as_of").agg(
                F.coalesce(F.max("severity"), F.lit(0)).cast("int").alias("severity"))
            stamped = rated.select("server_id", align_tick("as_of").cast("long").alias("timestamp"),
                                   F.lit(ALERT_SOURCE).alias("src_type"), "severity")
            with ThreadPoolExecutor(2) as pool:
                writing = [pool.submit(copy_context().run, registry, changed.filter(is_known()).select(*LIVE_REGISTRY.names), batch_id),
                           pool.submit(copy_context().run, states, stamped, batch_id)]
            for one in writing:
                one.result()
        finally:
            batch.unpersist()

    return handle


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The incidents that a stream with timers holds now."""
    return read_upserts(spark, path, LIVE_REGISTRY, REGISTRY_KEYS).filter("live").drop("live")
