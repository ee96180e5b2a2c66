"""The metric and alert streams end to end."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from beaconry.operators.lookup import metric_thresholds
from beaconry.operators.merge import latest_per_key
from beaconry.schemas import SERVER_STATE
from beaconry.sources.messages import PREFIXES, accepted, decode_alert, decode_metric, fork, quarantined, route
from beaconry.streaming import windows as w
from beaconry.streaming.alerts import LIVE_REGISTRY, REGISTRY_KEYS, TIME_TO_LIVE, change_sink, identify, is_known
from beaconry.streaming.incidents import incident_changes
from beaconry.streaming.sinks import (
    ALERT_SINK,
    METRIC_SINK,
    STATE_SINK_COLUMNS,
    Sink,
    read_upserts,
    start_query,
    start_update_query,
    state_keys,
    upsert_sink,
)


# a master table, or how to read it as it is now
Table = DataFrame | Callable[[], DataFrame]


def now(table: Table) -> DataFrame:
    return table() if callable(table) else table


UNKNOWN_COLUMNS = ["hostname", "timestamp", "src_type"]


def _quarantining(accept: Sink, quarantine_path: str) -> Sink:
    """Write valid messages to the sink and the others, unchanged, to a quarantine table."""
    reject = upsert_sink(quarantine_path, ["raw"])

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            accept(accepted(batch), batch_id)
            reject(quarantined(batch), batch_id)
        finally:
            batch.unpersist()

    return handle


def metric_windows(metrics: DataFrame, watermark: str = w.METRIC_WATERMARK, size: int = w.WINDOW_SECONDS,
                   slide: int = w.SLIDE_SECONDS, final: bool = False) -> DataFrame:
    """Typed metric rows, deduplicated and averaged per sliding window; ``final`` is for queries in append mode."""
    unique = w.dedup_stream(w.with_event_time(metrics, "timestamp", watermark), ["id"], "timestamp")
    return w.sliding_mean(unique, size=size, slide=slide, final=final)


def rating_sink(server: Table, threshold: Table, metric: str, states: Sink, unknown: Sink) -> Sink:
    """Rate each micro-batch of windows against the servers and thresholds of that moment.

    Tables given as functions are read anew for every batch, so a new host or a changed threshold counts from the next
    batch on. Windows without a known host or threshold go to ``unknown``.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            rated = w.evaluate_metric(batch, metric_thresholds(now(server), now(threshold), metric), metric)
            states(w.known_states(rated), batch_id)
            unknown(w.unknown_hosts(rated), batch_id)
        finally:
            batch.unpersist()

    return handle


def metric_stream(
    trunk: DataFrame,
    server: Table,
    threshold: Table,
    metric: str,
    root: str,
    prefix: str | None = None,
    available_now: bool = False,
    final: bool = False,
    **window_options,
) -> list[StreamingQuery]:
    """Persist the raw rows of one metric and evaluate its windows, as two queries.

    By default a window is rated again whenever rows of it come in. With ``final`` it is rated once, when the watermark
    has passed its end; a row then enters the state once, not once for each window it lies in.

    Under ``root``: ``<metric>`` raw rows, ``server_state_<metric>`` states, ``quarantine_<metric>`` unusable messages,
    ``quarantine_<metric>_unknown`` windows of hosts that are not listed, and ``checkpoints``.
    """
    decoded = decode_metric(route(trunk, prefix or PREFIXES[metric]))
    raw_sink = _quarantining(upsert_sink(f"{root}/{metric}", METRIC_SINK[1], METRIC_SINK[0]), f"{root}/quarantine_{metric}")
    state_sink = upsert_sink(f"{root}/server_state_{metric}", STATE_SINK_COLUMNS, state_keys())
    unknown = upsert_sink(f"{root}/quarantine_{metric}_unknown", UNKNOWN_COLUMNS, UNKNOWN_COLUMNS)
    rate = rating_sink(server, threshold, metric, state_sink, unknown)

    def persist(stream: DataFrame) -> StreamingQuery:
        name = f"persist_{metric}"
        return start_update_query(stream, raw_sink, f"{root}/checkpoints/{name}", name, available_now)

    def evaluate(stream: DataFrame) -> StreamingQuery:
        name = f"evaluate_{metric}"
        windows = metric_windows(accepted(stream), final=final, **window_options)
        return start_query(windows, rate, f"{root}/checkpoints/{name}", name, available_now, mode="append" if final else "update")

    return fork(decoded, persist, evaluate)


def alert_stream(
    trunk: DataFrame,
    server: Table,
    alert_index: Table,
    root: str,
    prefix: str = PREFIXES["alert"],
    ttl: int | None = TIME_TO_LIVE,
    clock: Callable[[], int] | None = None,
    available_now: bool = False,
    offer: Callable[[DataFrame, int], None] | None = None,
) -> list[StreamingQuery]:
    """Persist raw alerts and keep the incidents of each host as state with timers, as two queries.

    No watermark limits the incidents but the time to live: without one, a CLOSED that arrives days late still closes its
    incident. An incident that expires clears its server's state, whichever server's alert moved time on. Tables given as
    functions are read anew for every micro-batch.

    ``offer`` is handed the states of each batch as well, for example to set them out for the health query.

    Under ``root``: ``alert`` raw rows, ``server_state_alert`` states, ``registry`` incidents (see ``read_registry``),
    ``quarantine_alert`` unusable messages, ``quarantine_alert_unknown`` alerts of unknown hosts or types, and
    ``checkpoints``.
    """
    decoded = decode_alert(route(trunk, prefix))
    raw = upsert_sink(f"{root}/alert", ALERT_SINK[1], ALERT_SINK[0])
    states = upsert_sink(f"{root}/server_state_alert", STATE_SINK_COLUMNS, state_keys())
    unknown = upsert_sink(f"{root}/quarantine_alert_unknown", ["id", "hostname", "message", "status", "timestamp"], ["id"])
    registry = upsert_sink(f"{root}/registry", LIVE_REGISTRY.names, REGISTRY_KEYS)

    def rated(batch: DataFrame, batch_id: int) -> None:
        states(batch, batch_id)
        if offer:
            offer(batch, batch_id)

    def keep(batch: DataFrame, batch_id: int) -> None:
        raw(batch, batch_id)
        servers = now(server).withColumnRenamed("id", "server_id")
        unknown(identify(batch, servers, now(alert_index)).filter(~is_known()), batch_id)

    def persist(stream: DataFrame) -> StreamingQuery:
        return start_update_query(stream, _quarantining(keep, f"{root}/quarantine_alert"),
                                  f"{root}/checkpoints/persist_alert", "persist_alert", available_now)

    def evaluate(stream: DataFrame) -> StreamingQuery:
        sink = change_sink(lambda: now(server), lambda: now(alert_index), registry, rated)
        return start_update_query(incident_changes(accepted(stream), ttl, clock), sink, f"{root}/checkpoints/evaluate_alert",
                                  "evaluate_alert", available_now)

    return fork(decoded, persist, evaluate)


def read_states(spark: SparkSession, root: str, sources: Sequence[str], shared_key: bool = False) -> DataFrame:
    """Current server states of several streams written under one root.

    With ``shared_key`` a server and time has one state, that of the last source listed.
    """
    parts = [
        read_upserts(spark, f"{root}/server_state_{s}", SERVER_STATE, state_keys(), few=True).withColumn("__rank", F.lit(i))
        for i, s in enumerate(sources)
    ]
    states = parts[0]
    for part in parts[1:]:
        states = states.unionByName(part)
    if shared_key:
        states = latest_per_key(states, state_keys(shared_key), [F.desc("__rank")])
    return states.drop("__rank")
