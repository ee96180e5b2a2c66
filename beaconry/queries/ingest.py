"""Queries for extracts, ticks, landing, table maintenance and messages."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from beaconry import schemas
from beaconry.functions import times
from beaconry.functions.messages import decode_server_document, encode_json
from beaconry.operators.lookup import server_documents, server_snapshot
from beaconry.plans.layers import build_src_metric
from beaconry.queries.adapters import NOW, Tables, stamp
from beaconry.queries.registry import query
from beaconry.session import fresh_path, materialize
from beaconry.sources import extract as x
from beaconry.sources import messages as m
from beaconry.sources import polling
from beaconry.sources import tables as st
from beaconry.streaming import sinks
from beaconry.streaming.windows import dedup_stream

METRIC_LIST = f'id, name, hostname, value, {stamp(chr(34) + "timestamp" + chr(34))} AS "timestamp"'


# ---------------------------------------------------------------- extracts


@query("extract_master", "changes", f"""
    SELECT id, status, priority, {stamp('update_time')} AS update_time FROM changes
    WHERE update_time BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-06-30'""")
def extract_master(t: Tables):
    rows = x.incremental_extract(t.changes, "update_time", "1996-01-01", "1996-06-30", closed="both")
    return rows.select("id", "status", "priority", "update_time")


@query("extract_metric", "metric", f"""
    SELECT {METRIC_LIST} FROM metric
    WHERE "timestamp" >= TIMESTAMP '2024-01-10' AND "timestamp" < TIMESTAMP '2024-01-20'""")
def extract_metric(t: Tables):
    return x.incremental_extract(t.metric, "timestamp", "2024-01-10", "2024-01-20")


@query("extract_trailing_window", "metric", f"""
    SELECT {METRIC_LIST} FROM metric
    WHERE "timestamp" > TIMESTAMP '2024-01-09' AND "timestamp" <= TIMESTAMP '2024-01-10'""")
def extract_trailing_window(t: Tables):
    return x.trailing_window(t.metric, "timestamp", "2024-01-10", 86_400)


@query("extract_alert_open_window", "alert", f"""
    SELECT id, message, hostname, status, {stamp('"timestamp"')} AS "timestamp", {stamp('created_time')} AS created_time
    FROM alert WHERE created_time > TIMESTAMP '2024-01-09' AND created_time < TIMESTAMP '2024-01-10'""")
def extract_alert_open_window(t: Tables):
    return x.trailing_window(t.alert, "created_time", "2024-01-10", 86_400, closed="neither")


@query("extract_partition_range", "metric", f"""
    SELECT {METRIC_LIST}, creation_date FROM metric
    WHERE creation_date >= '2024-01-05' AND creation_date < '2024-01-12'""")
def extract_partition_range(t: Tables):
    path = fresh_path(t.spark, "metric")
    st.overwrite_partitions(t.dated_metric, path, ["creation_date"], rebalance=True)
    schema = schemas.extend(schemas.METRIC, creation_date=schemas.STR)
    return st.read_partition_range(t.spark, path, schema, "creation_date", "2024-01-05", "2024-01-12")


@query("date_range_half_open", "metric", """
    SELECT creation_date, COUNT(*) AS n, CAST(SUM(value) AS BIGINT) AS total FROM metric
    WHERE creation_date >= '2024-01-05' AND creation_date < '2024-01-12' GROUP BY creation_date""")
def date_range_half_open(t: Tables):
    rows = x.date_range(t.dated_metric, "creation_date", "2024-01-05", "2024-01-12")
    return rows.groupBy("creation_date").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query("date_range_inclusive", "metric", """
    SELECT creation_date, COUNT(*) AS n, CAST(SUM(value) AS BIGINT) AS total FROM metric
    WHERE creation_date BETWEEN '2024-01-05' AND '2024-01-12' GROUP BY creation_date""")
def date_range_inclusive(t: Tables):
    rows = x.date_range(t.dated_metric, "creation_date", "2024-01-05", "2024-01-12", closed="both")
    return rows.groupBy("creation_date").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query("ticks_assign", sql="""
    WITH ticked AS (SELECT value, ((epoch_us(ts) + 4999999) // 5000000) * 5 AS tick FROM events)
    SELECT tick, COUNT(*) AS n, CAST(SUM(CAST(ROUND(value) AS BIGINT)) AS BIGINT) AS total FROM ticked GROUP BY tick""")
def ticks_assign(t: Tables):
    ticked = x.assign_tick(t.metric, "timestamp")
    return ticked.groupBy("tick").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


WAVES_SQL = """
    WITH arriving AS (
        SELECT event_id, epoch_us(ts) AS us, epoch_us(ts) + (event_id % 60) * 1000000 AS arrival_us FROM events),
    waves AS (
        SELECT event_id, 0 AS wave_offset, ((us + 4999999) // 5000000) * 5 AS read_tick, arrival_us FROM arriving
        UNION ALL
        SELECT event_id, 60, ((us + 60000000 + 4999999) // 5000000) * 5, arrival_us FROM arriving),
    seen AS (SELECT * FROM waves WHERE arrival_us <= read_tick * 1000000)
"""


def arriving(metrics):
    """Metrics that arrive up to 59 seconds after their event."""
    micros = F.unix_micros("timestamp") + F.col("id") % 60 * 1_000_000
    return metrics.withColumn("arrival", F.timestamp_micros(micros))


@query("waves_extract", sql=WAVES_SQL + "SELECT event_id AS id, wave_offset, read_tick FROM seen")
def waves_extract(t: Tables):
    return x.multi_wave_extract(arriving(t.metric), "timestamp", "arrival").select("id", "wave_offset", "read_tick")


@query("waves_polled", sql=WAVES_SQL + "SELECT event_id AS id, wave_offset, read_tick FROM seen")
def waves_polled(t: Tables):
    """The same waves read by a poll that is stopped and started again half-way."""
    root = fresh_path(t.spark, "poll")
    columns = ["id", "wave_offset", "read_tick"]
    first, last = t.metric.agg(F.unix_timestamp(F.min("timestamp")), F.unix_timestamp(F.max("timestamp"))).first()
    for until in ((first + last) // 2, last + 120):
        polling.poll(t.spark, arriving(t.metric), "timestamp", sinks.upsert_sink(f"{root}/rows", columns), f"{root}/checkpoint",
                     first - 10, until=until, arrival_col="arrival", available_now=True).awaitTermination()
    schema = schemas.struct(id=schemas.LONG, wave_offset=schemas.INT, read_tick=schemas.LONG)
    return sinks.read_upserts(t.spark, f"{root}/rows", schema)


@query("waves_union", sql=WAVES_SQL + "SELECT wave_offset, COUNT(*) AS n FROM seen GROUP BY wave_offset")
def waves_union(t: Tables):
    waves = [x.single_wave(arriving(t.metric), "timestamp", "arrival", 5, o) for o in (0, 60)]
    return x.union_waves(*waves).groupBy("wave_offset").agg(F.count("*").alias("n"))


@query("waves_dedup", "metric", f"SELECT {METRIC_LIST} FROM metric")
def waves_dedup(t: Tables):
    waves = x.multi_wave_extract(arriving(t.metric), "timestamp", "arrival")
    return dedup_stream(waves.select(*schemas.METRIC.names), ["id"], "timestamp")


# ---------------------------------------------------------------- landing and table maintenance


@query("land_extract", "metric", """
    SELECT id, name, hostname, value, CAST("timestamp" AS VARCHAR) AS "timestamp" FROM metric""")
def land_extract(t: Tables):
    return st.land_extract(t.metric, fresh_path(t.spark, "landing"))


HOUR_LIST = ('dwid, db_date, ' + stamp("db_hour") + ' AS db_hour, "year", "month", "day", "hour", "quarter", week, '
             "day_name, month_name, weekend_flag")


@query("read_hour_csv", "dim_hour", f"SELECT {HOUR_LIST} FROM dim_hour")
def read_hour_csv(t: Tables):
    path = fresh_path(t.spark, "hours")
    t.dim_hour.write.option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    return st.read_hour_csv(t.spark, path)


@query("dim_hour", "dim_hour", f"SELECT {HOUR_LIST} FROM dim_hour")
def dim_hour(t: Tables):
    return t.dim_hour


@query("overwrite_partitions", "metric", """
    SELECT id, CASE WHEN creation_date >= '2024-01-10' AND creation_date < '2024-01-15' THEN value + 1000 ELSE value END AS value,
           creation_date
    FROM metric""")
def overwrite_partitions(t: Tables):
    path = fresh_path(t.spark, "partitions")
    rows = t.dated_metric.select("id", "value", "creation_date")
    st.overwrite_partitions(rows, path, ["creation_date"], rebalance=True)
    again = x.date_range(rows, "creation_date", "2024-01-10", "2024-01-15")
    st.overwrite_partitions(again.withColumn("value", F.col("value") + 1000), path, ["creation_date"], rebalance=True)
    return t.spark.read.schema(rows.schema).parquet(path)


@query("replace_table", "metric", """
    SELECT hostname, CAST(SUM(value) AS BIGINT) AS total, CAST(SUM(value) * 2 AS BIGINT) AS doubled
    FROM metric GROUP BY hostname""")
def replace_table(t: Tables):
    path = fresh_path(t.spark, "replaced")
    first = st.replace_table(t.metric.groupBy("hostname").agg(F.sum("value").alias("total")), path)
    return st.replace_table(first.withColumn("doubled", F.col("total") * 2), path)


LAYER_NAMES = ("tmp", "src", "dwh", "dmt")


@query("layer_tables", "metric", f"""
    SELECT l.layer, creation_date, COUNT(*) AS n, CAST(0 AS BIGINT) AS after_truncate
    FROM metric, (VALUES {', '.join(f"('{n}')" for n in LAYER_NAMES)}) AS l(layer) GROUP BY ALL""")
def layer_tables(t: Tables):
    """All four layers under database names of their own: every one gets the metrics and is emptied again."""
    prefix = f"beaconry_{uuid.uuid4().hex}_"
    typed = build_src_metric(t.metric, NOW)
    dated = [c for c in typed.columns if c != "creation_date"]
    parts = []
    try:
        for layer in LAYER_NAMES:
            st.create_tables(t.spark, layer, fresh_path(t.spark, f"layer-{layer}"), prefix)
            table = f"{prefix}{layer}.{'fact_metric' if layer == 'dmt' else 'metric'}"
            columns = t.spark.table(table).columns
            filled = typed.select(*[F.col(c) if c in (*dated, "creation_date") else F.lit(0).alias(c) for c in columns])
            st.insert_table(filled, table)
            day = F.col("creation_date") if "creation_date" in columns else F.substring("timestamp", 1, 10)
            counts = materialize(t.spark.table(table).groupBy(day.alias("creation_date")).agg(F.count("*").alias("n")), "counts")
            st.truncate_tables(t.spark, layer, prefix)
            left = sum(t.spark.table(name).count() for name in st.layer_tables(layer, prefix))
            parts.append(counts.select(F.lit(layer).alias("layer"), "creation_date", "n", F.lit(left).cast("long").alias("after_truncate")))
    finally:
        for layer in LAYER_NAMES:
            if t.spark.catalog.databaseExists(f"{prefix}{layer}"):
                st.drop_tables(t.spark, layer, prefix)
    return x.union_waves(*parts)


@query("compact_partitions", "metric", f"SELECT {METRIC_LIST}, creation_date FROM metric")
def compact_partitions(t: Tables):
    path = fresh_path(t.spark, "compacted")
    schema = schemas.extend(schemas.METRIC, creation_date=schemas.STR)
    st.overwrite_partitions(t.dated_metric, path, ["creation_date"])
    st.compact_partitions(t.spark, path, schema, "creation_date", *t.days)
    return t.spark.read.schema(schema).parquet(path)


# ---------------------------------------------------------------- messages


@query("messages_encode", "metric", """
    SELECT id, 'cu' AS prefix, TRUE AS salt_in_range, name, hostname, value,
           CAST(floor(epoch("timestamp")) AS BIGINT) AS "timestamp"
    FROM metric""")
def messages_encode(t: Tables):
    sent = m.to_messages(t.metric, "cu")
    salt = F.split("key", r"\|")[1].cast("int")
    return sent.select(
        F.split("key", r"\|")[0].alias("prefix"), ((salt >= 0) & (salt < 100)).alias("salt_in_range"),
        F.from_json("value", schemas.METRIC_MESSAGE).alias("m"),
    ).select("prefix", "salt_in_range", "m.*")


def trunk(t: Tables, metrics=None):
    """All metrics as messages: clicks under ``cu``, views under ``mu``, the rest under ``ot``."""
    prefix = F.when(F.col("name") == "click", "cu").when(F.col("name") == "view", "mu").otherwise("ot")
    return m.to_messages(t.metric if metrics is None else metrics, prefix)


@query("route_prefix", sql="""
    SELECT CASE event_type WHEN 'click' THEN 'cu' ELSE 'mu' END AS prefix, COUNT(*) AS n
    FROM events WHERE event_type IN ('click', 'view') GROUP BY 1""")
def route_prefix(t: Tables):
    parts = [m.route(trunk(t), p).select(F.lit(p).alias("prefix")) for p in ("cu", "mu")]
    return x.union_waves(*parts).groupBy("prefix").agg(F.count("*").alias("n"))


@query("json_decode_metric", "metric", """
    SELECT id, name, hostname, value, strftime(date_trunc('second', "timestamp"), '%Y-%m-%d %H:%M:%S.%f') AS "timestamp"
    FROM metric""")
def json_decode_metric(t: Tables):
    return m.accepted(m.decode_metric(m.to_messages(t.metric, "cu")))


def damaged(t: Tables):
    """Alert messages of which some are cut short and some carry an unknown status."""
    alerts = t.alert.drop("created_time").withColumn(
        "status", F.when(F.col("hostname") == "svr1", "ACKNOWLEDGED").otherwise(F.col("status")))
    sent = m.to_messages(alerts, "al")
    short = F.expr("substring(value, 1, length(value) - 5)")
    return sent.withColumn("value", F.when(F.col("value").contains('"hostname":"svr2"'), short).otherwise(F.col("value")))


@query("json_decode_alert", "alert", f"""
    SELECT id, message, hostname, status, {stamp('"timestamp"')} AS "timestamp"
    FROM alert WHERE hostname NOT IN ('svr1', 'svr2')""")
def json_decode_alert(t: Tables):
    return m.accepted(m.decode_alert(damaged(t)))


@query("json_quarantine", "alert", "SELECT hostname, COUNT(*) AS n FROM alert WHERE hostname IN ('svr1', 'svr2') GROUP BY hostname")
def json_quarantine(t: Tables):
    host = F.regexp_extract("raw", '"hostname":"([^"]+)"', 1)
    return m.quarantined(m.decode_alert(damaged(t))).groupBy(host.alias("hostname")).agg(F.count("*").alias("n"))


@query("json_encode", "metric", """
    SELECT id, '{"id":' || id || ',"name":"' || name || '","hostname":"' || hostname || '","value":' || value
        || ',"timestamp":' || CAST(floor(epoch("timestamp")) AS BIGINT) || '}' AS document
    FROM metric""")
def json_encode(t: Tables):
    return t.metric.select("id", encode_json(t.metric).alias("document"))


@query("json_server_document", "server metric_threshold", """
    SELECT s.id, s.hostname, s.cpu_cores, s.memory, s.app_id, t.metric_name, t.amber_threshold, t.red_threshold,
           epoch_ms(t.update_time) AS threshold_updated_ms, epoch_ms(s.update_time) AS updated_ms
    FROM server s JOIN metric_threshold t ON t.server_id = s.id""")
def json_server_document(t: Tables):
    documents = server_documents(server_snapshot(t.server, t.metric_threshold))
    back = documents.select(decode_server_document("document").alias("d")).select("d.*")
    flat = back.select("*", F.explode("metricThresholds").alias("metric_name", "threshold"))
    return flat.select(
        "id", "hostname", F.col("cpuCores").alias("cpu_cores"), "memory", F.col("appId").alias("app_id"), "metric_name",
        F.col("threshold.amberThreshold").alias("amber_threshold"), F.col("threshold.redThreshold").alias("red_threshold"),
        F.col("threshold.updateTime").alias("threshold_updated_ms"), F.col("updateTime").alias("updated_ms"))


@query("json_props", sql="SELECT event_id AS id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(t: Tables):
    return t.events.select(F.col("event_id").alias("id"), F.from_json("props", "k long").getField("k").alias("k"))


# ---------------------------------------------------------------- time expressions


@query("time_expressions", sql=f"""
    SELECT event_id AS id, {stamp('ts')} AS parsed, strftime(ts, '%Y-%m-%d') AS day_text,
           {stamp("date_trunc('hour', ts)")} AS hour_start, {stamp("date_trunc('day', ts)")} AS day_start,
           CAST(floor(epoch(ts)) AS BIGINT) AS epoch, {stamp("ts - INTERVAL 5 SECOND")} AS five_before,
           (CAST(floor(epoch(ts)) AS BIGINT) // 5 + 1) * 5 AS next_tick,
           ((CAST(floor(epoch(ts)) AS BIGINT) + 4) // 5) * 5 AS on_tick
    FROM events""")
def time_expressions(t: Tables):
    text = t.events.select("event_id", F.col("ts").cast("string").alias("text"))
    rows = text.select("event_id", times.parse_timestamp("text").alias("ts"))
    return rows.select(
        F.col("event_id").alias("id"), F.col("ts").alias("parsed"), times.date_string("ts").alias("day_text"),
        times.hour_start("ts").alias("hour_start"), times.day_start(times.date_string("ts")).alias("day_start"),
        times.epoch_seconds("ts").alias("epoch"), times.seconds_before("ts", 5).alias("five_before"),
        times.align_tick(times.epoch_seconds("ts")).alias("next_tick"),
        times.align_tick(times.epoch_seconds("ts"), strict=False).alias("on_tick"))


@query("calendar_parts", sql="""
    SELECT o_orderkey AS id, CAST(year(o_orderdate) AS INTEGER) AS "year", CAST(month(o_orderdate) AS INTEGER) AS "month",
           CAST(day(o_orderdate) AS INTEGER) AS "day", CAST(hour(o_orderdate) AS INTEGER) AS "hour",
           CAST(quarter(o_orderdate) AS INTEGER) AS "quarter", CAST(strftime(o_orderdate, '%W') AS INTEGER) AS week,
           strftime(o_orderdate, '%A') AS day_name, strftime(o_orderdate, '%B') AS month_name,
           isodow(o_orderdate) >= 6 AS weekend_flag
    FROM orders""")
def calendar_parts(t: Tables):
    parts = times.calendar_parts("o_orderdate")
    return t.orders.select(F.col("o_orderkey").alias("id"), *[c.alias(n) for n, c in parts.items()])
