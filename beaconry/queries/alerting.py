"""Queries for sliding windows, alert state, server health and the streams themselves."""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconry import schemas
from beaconry.operators import aggregates as agg
from beaconry.operators.lookup import all_thresholds, metric_thresholds
from beaconry.queries.adapters import Tables
from beaconry.queries.ingest import METRIC_LIST, arriving, trunk
from beaconry.queries.registry import query
from beaconry.session import fresh_path
from beaconry.sources import extract as x
from beaconry.sources import messages as m
from beaconry.streaming import alerts as al
from beaconry.streaming import fanout, sinks, streams
from beaconry.streaming import windows as w

# the test events are sparse, so windows are six hours long and slide by half an hour
SIZE, SLIDE = 6 * 3600, 1800


def windows_sql(rows: str) -> str:
    return f"""
    WITH tiles AS (
        SELECT hostname, user_id, (CAST(floor(epoch("timestamp")) AS BIGINT) // {SLIDE} + k) * {SLIDE} AS "timestamp", value
        FROM {rows}, generate_series(1, {SIZE // SLIDE}) AS g(k)),
    means AS (SELECT hostname, user_id, "timestamp", AVG(value) AS avg FROM tiles GROUP BY hostname, user_id, "timestamp")
    """


def states_sql(metric: str, rows: str) -> str:
    """Two views: the windows of one metric and their rating."""
    return windows_sql(rows) + f""",
    rated AS (
        SELECT s.id AS server_id, g."timestamp", '{metric}' AS src_type,
               CASE WHEN avg < amber_threshold THEN 0 WHEN avg >= red_threshold THEN 2 ELSE 1 END AS severity
        FROM means g JOIN server s ON s.hostname = g.hostname
        JOIN metric_threshold t ON t.server_id = s.id AND t.metric_name = '{metric}')"""


# ---------------------------------------------------------------- sliding windows


@query("sliding_mean", "metric", windows_sql("metric") + 'SELECT hostname, "timestamp", ROUND(avg, 6) AS avg FROM means')
def sliding_mean(t: Tables):
    return w.sliding_mean(t.metric, size=SIZE, slide=SLIDE).withColumn("avg", F.round("avg", 6))


CLICKS = "(SELECT * FROM metric WHERE name = 'click')"


def rated_windows(t: Tables, metric: str):
    windows = w.sliding_mean(t.metric.filter(F.col("name") == metric), size=SIZE, slide=SLIDE)
    return w.evaluate_metric(windows, metric_thresholds(t.server, t.metric_threshold, metric), metric)


@query("sliding_states", "metric server metric_threshold",
       states_sql("click", CLICKS) + 'SELECT server_id, "timestamp", src_type, severity FROM rated')
def sliding_states(t: Tables):
    return w.known_states(rated_windows(t, "click"))


@query("sliding_unknown_hosts", "metric server metric_threshold", windows_sql(CLICKS) + """
    SELECT hostname, "timestamp", 'click' AS src_type FROM means WHERE hostname NOT IN (
        SELECT s.hostname FROM server s JOIN metric_threshold t ON t.server_id = s.id AND t.metric_name = 'click'
        WHERE s.segment <> 'BUILDING')""")
def sliding_unknown_hosts(t: Tables):
    """Windows of hosts missing from a server list that lacks one market segment."""
    listed = t.customer.filter("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("id"))
    servers = t.server.join(listed, "id", "left_semi")
    windows = w.sliding_mean(t.metric.filter("name = 'click'"), size=SIZE, slide=SLIDE)
    rated = w.evaluate_metric(windows, metric_thresholds(servers, t.metric_threshold, "click"), "click")
    return w.unknown_hosts(rated)


HEALTH_STEP = 3600


@query("health", "metric alert alert_index server metric_threshold", f"""
    WITH windows AS (
        SELECT hostname, name, (CAST(floor(epoch("timestamp")) AS BIGINT) // {SLIDE} + k) * {SLIDE} AS "timestamp", AVG(value) AS avg
        FROM metric, generate_series(1, {SIZE // SLIDE}) AS g(k) GROUP BY 1, 2, 3),
    registry AS (
        SELECT user_id, severity, bool_or(status = 'OPEN') AS opened, bool_or(status = 'CLOSED') AS closed
        FROM alert a JOIN alert_index i ON i.name = a.message GROUP BY user_id, severity, "timestamp"),
    states AS (
        SELECT s.id AS server_id, g."timestamp",
               CASE WHEN avg < amber_threshold THEN 0 WHEN avg >= red_threshold THEN 2 ELSE 1 END AS severity
        FROM windows g JOIN server s ON s.hostname = g.hostname
        JOIN metric_threshold t ON t.server_id = s.id AND t.metric_name = g.name
        UNION ALL
        SELECT user_id, (SELECT CAST(epoch(MAX("timestamp")) AS BIGINT) + 5 FROM alert),
               MAX(CASE WHEN opened AND NOT closed THEN severity ELSE 0 END)
        FROM registry GROUP BY user_id)
    SELECT server_id, (("timestamp" + {HEALTH_STEP - 1}) // {HEALTH_STEP}) * {HEALTH_STEP} AS "timestamp", MAX(severity) AS severity
    FROM states GROUP BY 1, 2""")
def health(t: Tables):
    """Every metric and the alerts, in one pass over the metrics."""
    parts = w.window_parts(t.metric, SIZE, SLIDE)
    windows = w.sliding_mean(t.metric, size=SIZE, slide=SLIDE, by=["name"], parts=parts)
    rated = w.evaluate_metrics(windows, all_thresholds(t.server, t.metric_threshold), parts=parts)
    return w.server_health(x.union_waves(w.known_states(rated), alert_states(t)), HEALTH_STEP, parts)


@query("late_rows", sql="""
    WITH arriving AS (SELECT event_id AS id, ts, ts + to_hours(CAST(event_id % 60 AS INTEGER)) AS arrival FROM events)
    SELECT id FROM arriving WHERE arrival >= TIMESTAMP '2024-01-15'
    AND ts < (SELECT MAX(ts) FROM arriving WHERE arrival < TIMESTAMP '2024-01-15') - INTERVAL 10 MINUTE""")
def late_rows(t: Tables):
    """What arrives after mid January although it is older than the watermark reached by then."""
    micros = F.unix_micros("timestamp") + F.col("id") % 60 * 3_600_000_000
    rows = t.metric.withColumn("arrival", F.timestamp_micros(micros))
    half = F.lit("2024-01-15").cast("timestamp")
    seen, later = rows.filter(F.col("arrival") < half), rows.filter(F.col("arrival") >= half)
    return w.late_rows(later, seen, "timestamp", "10 MINUTES").select("id")


# ---------------------------------------------------------------- alert state


def identified(t: Tables):
    return al.identify(t.alert, t.server.withColumnRenamed("id", "server_id"), t.alert_index)


def registry(t: Tables):
    return agg.incident_registry(identified(t).filter(al.is_known()))


def alert_states(t: Tables):
    newest = t.alert.agg(F.unix_timestamp(F.max("timestamp")).alias("t")).scalar()
    return al.evaluate_alerts(registry(t), t.alert_index, newest)


REGISTRY_SQL = """
    WITH registry AS (
        SELECT user_id AS server_id, i.id AS alert_id, i.severity, CAST(epoch("timestamp") AS BIGINT) AS incident_ts,
               bool_or(status = 'OPEN') AS opened, bool_or(status = 'CLOSED') AS closed
        FROM alert a JOIN alert_index i ON i.name = a.message GROUP BY 1, 2, 3, 4)
"""
SEVERITY = "CAST(MAX(CASE WHEN opened AND NOT closed THEN severity ELSE 0 END) AS INTEGER) AS severity"
STATES_SQL = REGISTRY_SQL + f"""
    SELECT server_id, (SELECT (CAST(epoch(MAX("timestamp")) AS BIGINT) // 5 + 1) * 5 FROM alert) AS "timestamp",
           'alert' AS src_type, {SEVERITY}
    FROM registry GROUP BY server_id"""


@query("alert_registry", "alert alert_index", REGISTRY_SQL + "SELECT server_id, alert_id, incident_ts, opened, closed FROM registry")
def alert_registry(t: Tables):
    return registry(t)


@query("alert_registry_merged", "alert alert_index", REGISTRY_SQL + "SELECT server_id, alert_id, incident_ts, opened, closed FROM registry")
def alert_registry_merged(t: Tables):
    """Registries folded from the OPEN and the CLOSED alerts apart give the registry of both."""
    rows = identified(t).filter(al.is_known())
    parts = [agg.incident_registry(rows.filter(F.col("status") == s)) for s in ("CLOSED", "OPEN")]
    return agg.merge_registries(*parts)


@query("alert_severity", "alert alert_index", REGISTRY_SQL + f"SELECT server_id, {SEVERITY} FROM registry GROUP BY server_id")
def alert_severity(t: Tables):
    return agg.server_severity(registry(t), t.alert_index)


@query("alert_state", "alert alert_index", STATES_SQL)
def alert_state(t: Tables):
    return alert_states(t)


@query("alert_state_expired", "alert alert_index", REGISTRY_SQL + f"""
    SELECT server_id, {SEVERITY} FROM registry
    WHERE (SELECT CAST(epoch(MAX("timestamp")) AS BIGINT) FROM alert) - incident_ts < 864000 GROUP BY server_id""")
def alert_state_expired(t: Tables):
    newest = t.alert.agg(F.unix_timestamp(F.max("timestamp")).alias("t")).scalar()
    return agg.server_severity(agg.expire_incidents(registry(t), newest, 10 * 86_400), t.alert_index)


# ---------------------------------------------------------------- streams


def finish(*queries):
    for q in queries:
        q.awaitTermination()


def run_to_sink(t: Tables, df, columns, label: str, keys=()) -> str:
    """Run a stream over everything there is into a keyed sink and return the sink's folder."""
    root = fresh_path(t.spark, label)
    finish(sinks.start_update_query(df, sinks.upsert_sink(f"{root}/out", columns, keys), f"{root}/checkpoint", available_now=True))
    return f"{root}/out"


def metric_events(t: Tables):
    return t.as_metric(t.events_stream())


@query("stream_trunk", "metric", """
    SELECT id, name, hostname, value, CAST(floor(epoch("timestamp")) AS BIGINT) AS "timestamp" FROM metric""")
def stream_trunk(t: Tables):
    """Messages written to a folder, read back as a stream and decoded."""
    folder = fresh_path(t.spark, "trunk")
    trunk(t).write.parquet(folder)
    decoded = m.decode_metric(m.read_trunk_files(t.spark, folder)).filter("is_valid")
    path = run_to_sink(t, decoded, schemas.METRIC_MESSAGE.names, "trunk-run", ["id"])
    return sinks.read_upserts(t.spark, path, schemas.METRIC_MESSAGE, ["id"])


@query("stream_dedup", "metric", f"SELECT {METRIC_LIST} FROM metric")
def stream_dedup(t: Tables):
    """Both collection waves as a stream, its duplicates removed under a watermark."""
    waves = x.multi_wave_extract(arriving(metric_events(t)), "timestamp", "arrival")
    timed = w.with_event_time(waves.select(*schemas.METRIC.names), "timestamp", w.METRIC_WATERMARK)
    path = run_to_sink(t, w.dedup_stream(timed, ["id"], "timestamp"), schemas.METRIC.names, "dedup")
    return t.spark.read.schema(schemas.METRIC).parquet(f"{path}/delta").select(*schemas.METRIC.names)


@query("stream_upsert_metrics", "metric", f"SELECT {METRIC_LIST} FROM metric")
def stream_upsert_metrics(t: Tables):
    """Every metric sent twice; the sink keeps one row per id."""
    twice = metric_events(t).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    path = run_to_sink(t, twice, sinks.METRIC_SINK[1], "metrics", sinks.METRIC_SINK[0])
    return sinks.read_upserts(t.spark, path, schemas.METRIC, sinks.METRIC_SINK[0])


ALERT_ROW = schemas.extend(schemas.ALERT_MESSAGE)


@query("stream_upsert_alerts", "alert", """
    SELECT id, message, hostname, status, CAST(floor(epoch("timestamp")) AS BIGINT) AS "timestamp" FROM alert""")
def stream_upsert_alerts(t: Tables):
    rows = x.with_epoch(t.as_alert(t.events_stream()).drop("created_time"))
    path = run_to_sink(t, rows, sinks.ALERT_SINK[1], "alerts", sinks.ALERT_SINK[0])
    return sinks.compact_upserts(t.spark, path, ALERT_ROW, sinks.ALERT_SINK[0])


@query("stream_fork", sql="""
    SELECT event_type AS branch, COUNT(*) AS n FROM events WHERE event_type IN ('click', 'view') GROUP BY 1""")
def stream_fork(t: Tables):
    """One stream feeding two queries."""
    root = fresh_path(t.spark, "fork")

    def branch(kind):
        return lambda s: sinks.start_update_query(
            s.filter(F.col("name") == kind), sinks.upsert_sink(f"{root}/{kind}", schemas.METRIC.names),
            f"{root}/checkpoint-{kind}", f"fork_{kind}", available_now=True)

    finish(*m.fork(metric_events(t), branch("click"), branch("view")))
    rows = [sinks.read_upserts(t.spark, f"{root}/{k}", schemas.METRIC, ["id"]) for k in ("click", "view")]
    return x.union_waves(*rows).groupBy(F.col("name").alias("branch")).agg(F.count("*").alias("n"))


def run_metric_stream(t: Tables, root: str, metric: str, prefix: str, server=None) -> None:
    messages = trunk(t, metric_events(t))
    finish(*streams.metric_stream(messages, server or t.server, t.metric_threshold, metric, root, prefix,
                                  available_now=True, size=SIZE, slide=SLIDE))


@query("stream_metric_states", "metric server metric_threshold",
       states_sql("click", CLICKS) + 'SELECT server_id, "timestamp", src_type, severity FROM rated')
def stream_metric_states(t: Tables):
    root = fresh_path(t.spark, "metric-stream")
    run_metric_stream(t, root, "click", "cu")
    return streams.read_states(t.spark, root, ["click"])


@query("stream_unknown_hosts", "metric server metric_threshold", windows_sql(CLICKS) + """
    SELECT hostname, "timestamp", 'click' AS src_type FROM means WHERE hostname NOT IN (
        SELECT s.hostname FROM server s JOIN metric_threshold t ON t.server_id = s.id AND t.metric_name = 'click'
        WHERE s.segment <> 'BUILDING')""")
def stream_unknown_hosts(t: Tables):
    """What the stream sets aside when the server list lacks one market segment."""
    root = fresh_path(t.spark, "metric-stream")
    listed = t.customer.filter("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("id"))
    run_metric_stream(t, root, "click", "cu", lambda: t.server.join(listed, "id", "left_semi"))
    kind = schemas.struct(hostname=schemas.STR, timestamp=schemas.LONG, src_type=schemas.STR)
    return sinks.read_upserts(t.spark, f"{root}/quarantine_click_unknown", kind, streams.UNKNOWN_COLUMNS)


@query("stream_metric_raw", "metric", """
    SELECT id, name, hostname, value, strftime(date_trunc('second', "timestamp"), '%Y-%m-%d %H:%M:%S.%f') AS "timestamp"
    FROM metric WHERE name = 'view'""")
def stream_metric_raw(t: Tables):
    root = fresh_path(t.spark, "metric-stream")
    run_metric_stream(t, root, "view", "mu")
    return sinks.read_upserts(t.spark, f"{root}/view", schemas.METRIC, sinks.METRIC_SINK[0])


@query("stream_states_shared_key", "metric server metric_threshold", states_sql("click", CLICKS) + f""",
    view_means AS (
        SELECT hostname, (CAST(floor(epoch("timestamp")) AS BIGINT) // {SLIDE} + k) * {SLIDE} AS "timestamp", AVG(value) AS avg
        FROM (SELECT * FROM metric WHERE name = 'view'), generate_series(1, {SIZE // SLIDE}) AS g(k) GROUP BY 1, 2),
    view_rated AS (
        SELECT s.id AS server_id, g."timestamp", 'view' AS src_type,
               CASE WHEN avg < amber_threshold THEN 0 WHEN avg >= red_threshold THEN 2 ELSE 1 END AS severity
        FROM view_means g JOIN server s ON s.hostname = g.hostname
        JOIN metric_threshold t ON t.server_id = s.id AND t.metric_name = 'view')
    SELECT * FROM view_rated UNION ALL
    SELECT * FROM rated r WHERE NOT EXISTS (
        SELECT 1 FROM view_rated v WHERE v.server_id = r.server_id AND v."timestamp" = r."timestamp")""")
def stream_states_shared_key(t: Tables):
    """Two metrics under one state key: the later source wins."""
    root = fresh_path(t.spark, "metric-stream")
    run_metric_stream(t, root, "click", "cu")
    run_metric_stream(t, root, "view", "mu")
    return streams.read_states(t.spark, root, ["click", "view"], shared_key=True)


# the time to live of the streamed registry, in the query and in its oracle
STREAM_TTL = 10 * 86_400
# bytes of a row group of the alert messages
ROW_GROUP = 4 * 1024 * 1024


def run_alert_stream(t: Tables, ttl: int | None, files: int = 4, max_files: int = 1) -> str:
    """The alerts in several files; by default every file is a micro-batch of its own."""
    root = fresh_path(t.spark, "alert-stream")
    messages = m.to_messages(t.alert.drop("created_time"), m.PREFIXES["alert"])
    # several row groups, so that more than one task reads a large file
    messages.repartition(files).write.option("parquet.block.size", ROW_GROUP).parquet(f"{root}/trunk")
    trunk = m.read_trunk_files(t.spark, f"{root}/trunk", max_files)
    finish(*streams.alert_stream(trunk, t.server, t.alert_index, root, ttl=ttl, available_now=True))
    return root


@query("stream_alert_states", "alert alert_index", REGISTRY_SQL + f"""
    SELECT server_id, 'alert' AS src_type, {SEVERITY} FROM registry GROUP BY server_id""")
def stream_alert_states(t: Tables):
    """The last state of each server, nothing expired; when it was reached depends on the batches and is left out."""
    states = streams.read_states(t.spark, run_alert_stream(t, None), ["alert"])
    return states.groupBy("server_id", "src_type").agg(F.max_by("severity", "timestamp").alias("severity"))


@query("stream_alert_registry", "alert alert_index", REGISTRY_SQL + f"""
    SELECT server_id, alert_id, incident_ts, opened, closed FROM registry
    WHERE (SELECT CAST(epoch(MAX("timestamp")) AS BIGINT) FROM alert) - incident_ts < {STREAM_TTL}""")
def stream_alert_registry(t: Tables):
    return al.read_registry(t.spark, f"{run_alert_stream(t, STREAM_TTL)}/registry")


@query("stream_alert_expiry", "alert alert_index", REGISTRY_SQL + f""",
    live AS (SELECT *, (SELECT CAST(epoch(MAX("timestamp")) AS BIGINT) FROM alert) - incident_ts < {STREAM_TTL} AS is_live FROM registry)
    SELECT * FROM (SELECT server_id, {SEVERITY.replace("opened", "is_live AND opened")} FROM live GROUP BY server_id) WHERE severity > 0""")
def stream_alert_expiry(t: Tables):
    """The servers still in trouble when incidents expire; all whose incidents are too old are in order again."""
    states = streams.read_states(t.spark, run_alert_stream(t, STREAM_TTL), ["alert"])
    return states.groupBy("server_id").agg(F.max_by("severity", "timestamp").alias("severity")).filter("severity > 0")


@query("stream_alert_registry_stateful", "alert alert_index",
       REGISTRY_SQL + "SELECT server_id, alert_id, incident_ts, opened, closed FROM registry")
def stream_alert_registry_stateful(t: Tables):
    """The registry kept in the state store instead of a table."""
    rows = t.as_alert(t.events_stream()).drop("created_time")
    updates = al.registry_updates(rows, t.server.withColumnRenamed("id", "server_id"), t.alert_index)
    path = run_to_sink(t, updates, al.REGISTRY.names, "registry", al.REGISTRY_KEYS)
    return sinks.read_upserts(t.spark, path, al.REGISTRY, al.REGISTRY_KEYS)


# ---------------------------------------------------------------- one read for all metrics

BOTH_SQL = states_sql("click", CLICKS) + f""",
    view_means AS (
        SELECT hostname, (CAST(floor(epoch("timestamp")) AS BIGINT) // {SLIDE} + k) * {SLIDE} AS "timestamp", AVG(value) AS avg
        FROM (SELECT * FROM metric WHERE name = 'view'), generate_series(1, {SIZE // SLIDE}) AS g(k) GROUP BY 1, 2),
    both_rated AS (
        SELECT * FROM rated UNION ALL
        SELECT s.id AS server_id, g."timestamp", 'view' AS src_type,
               CASE WHEN avg < amber_threshold THEN 0 WHEN avg >= red_threshold THEN 2 ELSE 1 END AS severity
        FROM view_means g JOIN server s ON s.hostname = g.hostname
        JOIN metric_threshold t ON t.server_id = s.id AND t.metric_name = 'view')"""
KINDS = {"click": "cu", "view": "mu"}


def run_fan_out(t: Tables, **options) -> str:
    """All messages read once, then the windows of both metrics."""
    root = fresh_path(t.spark, "fan-out")
    finish(fanout.fan_out(trunk(t, metric_events(t)), root, KINDS, available_now=True))
    finish(*[fanout.window_query(t.spark, root, k, t.server, t.metric_threshold, available_now=True, size=SIZE, slide=SLIDE, **options)
             for k in KINDS])
    return root


@query("stream_fan_out_states", "metric server metric_threshold",
       BOTH_SQL + 'SELECT server_id, "timestamp", src_type, severity FROM both_rated')
def stream_fan_out_states(t: Tables):
    return streams.read_states(t.spark, run_fan_out(t), list(KINDS))


@query("stream_health", "metric server metric_threshold",
       BOTH_SQL + 'SELECT server_id, "timestamp", MAX(severity) AS severity FROM both_rated GROUP BY 1, 2')
def stream_health(t: Tables):
    """The states of both metrics as a stream, the worse of the two per server and tick."""
    root = run_fan_out(t, offer=True)
    finish(fanout.health_query(t.spark, root, list(KINDS), available_now=True))
    return fanout.read_health(t.spark, root)


LATE_SECONDS = 10 * 86_400


@query("stream_late_rows", "metric", f"""
    WITH m AS (SELECT id, name, CAST(floor(epoch("timestamp")) AS BIGINT) AS s FROM metric WHERE name IN ('click', 'view')),
    marks AS (SELECT name, MAX(s) - {LATE_SECONDS} AS w FROM m WHERE id % 10 <> 3 GROUP BY name)
    SELECT id, name AS kind, w AS watermark FROM m JOIN marks USING (name) WHERE id % 10 = 3 AND s <= w""")
def stream_late_rows(t: Tables):
    """A tenth of the rows sent after all others: those not younger than their metric's watermark are kept apart."""
    root = fresh_path(t.spark, "late")
    for late in (False, True):
        rows = trunk(t, t.metric.filter((F.col("id") % 10 == 3) == F.lit(late)))
        rows.coalesce(1).write.mode("append").parquet(f"{root}/trunk")
    messages = m.read_trunk_files(t.spark, f"{root}/trunk", max_files=1)
    finish(fanout.fan_out(messages, root, KINDS, LATE_SECONDS, available_now=True))
    return sinks.read_upserts(t.spark, f"{root}/late", fanout.LATE).select("id", "kind", "watermark")


@query("stream_sliding_final", "metric server metric_threshold", states_sql("click", CLICKS) + f"""
    SELECT server_id, "timestamp", src_type, severity FROM rated
    WHERE "timestamp" <= (SELECT CAST(floor(epoch(MAX("timestamp"))) AS BIGINT) FROM {CLICKS}) - 60""")
def stream_sliding_final(t: Tables):
    """Windows rated once, when the watermark has passed their end."""
    root = fresh_path(t.spark, "final")
    messages = trunk(t, metric_events(t))
    finish(*streams.metric_stream(messages, t.server, t.metric_threshold, "click", root, "cu", available_now=True, final=True,
                                  size=SIZE, slide=SLIDE))
    return streams.read_states(t.spark, root, ["click"])
