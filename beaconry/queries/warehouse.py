"""Queries for typing, merges, dimensions, joins and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconry import schemas
from beaconry.functions.messages import metric_key, state_key
from beaconry.functions.rating import gen_rag, register_gen_rag, severity, severity_label
from beaconry.operators import aggregates as agg
from beaconry.operators import joins as j
from beaconry.operators import lookup as lk
from beaconry.operators import merge as mg
from beaconry.operators import scd2 as sc
from beaconry.operators.numbering import max_key, number_rows
from beaconry.plans import daily, layers, marts
from beaconry.queries.adapters import NOW, Tables, stamp
from beaconry.queries.registry import query
from beaconry.session import fresh_path
from beaconry.sources import buckets as bk
from beaconry.sources.tables import as_text

# ---------------------------------------------------------------- typing

NOW_TEXT = "'2024-02-01 00:00:00.000000' AS imported_time"
AUDIT = f"{stamp('creation_time')} AS creation_time, {stamp('update_time')} AS update_time, {NOW_TEXT}"


def _src_master(table: str, columns: str) -> None:
    @query(f"src_{table}", table, f"SELECT {columns}, {AUDIT}, strftime(update_time, '%Y-%m-%d') AS update_date FROM {table}")
    def build(t: Tables):
        return layers.build_src_master(as_text(getattr(t, table)), table, NOW)


ATTRIBUTE_LISTS = {name: ", ".join(s.names) for name, s in schemas.ATTRIBUTES.items()}
for _table, _columns in ATTRIBUTE_LISTS.items():
    _src_master(_table, _columns)


@query("src_metric", "metric", f"""
    SELECT id, name, hostname, value, {stamp('"timestamp"')} AS "timestamp", {NOW_TEXT}, creation_date FROM metric""")
def src_metric(t: Tables):
    return layers.build_src_metric(as_text(t.metric), NOW)


@query("dwh_metric", "metric", f"""
    SELECT id, name, hostname, value, {stamp('"timestamp"')} AS "timestamp", {NOW_TEXT}, creation_date FROM metric
    WHERE creation_date >= '2024-01-03' AND creation_date < '2024-01-27'""")
def dwh_metric(t: Tables):
    return layers.build_dwh_metric(layers.build_src_metric(t.metric, NOW), "2024-01-03", "2024-01-27")


@query("src_change_set", "changes", """
    SELECT id, status, priority, update_date FROM changes
    WHERE update_date >= '1997-01-01' AND update_date < '1998-01-01'""")
def src_change_set(t: Tables):
    return sc.change_set(t.changes, ["id", "status", "priority"], "1997-01-01", "1998-01-01")


@query("src_drop_cols", "server", "SELECT id, app_id, hostname, cpu_cores, memory FROM server")
def src_drop_cols(t: Tables):
    return layers.drop_cols(t.server, "creation_time", "update_time", "row_num", "oc")


# ---------------------------------------------------------------- merges

SERVER_LIST = f"id, app_id, hostname, cpu_cores, memory, {stamp('update_time')} AS update_time"
MERGE_SQL = f"""
    WITH both_sides AS (
        SELECT id, app_id, hostname, cpu_cores, memory, update_time, 0 AS oc, CAST(0 AS BIGINT) AS tie FROM server
        UNION ALL
        SELECT id, app_id, hostname, cpu_cores, memory, update_time, 1, tie FROM server_changes),
    ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY update_time DESC, oc DESC, tie DESC) AS rn FROM both_sides)
    SELECT {SERVER_LIST} FROM ranked WHERE rn = 1"""


def full_and_delta(t: Tables):
    full = t.server.drop("creation_time").withColumn("tie", F.lit(0).cast("long"))
    return full, t.server_changes.drop("creation_time")


@query("merge_latest_server", "server server_changes", MERGE_SQL)
def merge_latest_server(t: Tables):
    full, delta = full_and_delta(t)
    return mg.merge_latest(full, delta, ["id"], ties=[F.desc("tie")]).drop("tie")


@query("merge_latest_narrow", "server server_changes", MERGE_SQL)
def merge_latest_narrow(t: Tables):
    """The same merge when the full table is known to be unique: only touched keys are shuffled."""
    full, delta = full_and_delta(t)
    return mg.merge_latest(full, delta, ["id"], ties=[F.desc("tie")], full_is_unique=True).drop("tie")


@query("merge_buckets", "server server_changes", MERGE_SQL)
def merge_in_buckets(t: Tables):
    """The same merge into a stored table, of which only the touched buckets are read and written."""
    full, delta = full_and_delta(t)
    path = fresh_path(t.spark, "buckets")
    for rows in (full, delta):
        bk.merge_buckets(t.spark, path, full.schema, ["id"], rows, ties=[F.desc("tie")])
    return bk.read_buckets(t.spark, path, full.schema).drop("tie")


@query("merge_latest_threshold", "metric_threshold", """
    WITH delta AS (
        SELECT user_id AS server_id, event_type AS metric_name, CAST(MAX(ROUND(value)) AS INTEGER) AS amber_threshold,
               CAST(MAX(ROUND(value)) + 20 AS INTEGER) AS red_threshold
        FROM events WHERE value > 100 GROUP BY 1, 2)
    SELECT m.server_id, m.metric_name, COALESCE(d.amber_threshold, m.amber_threshold) AS amber_threshold,
           COALESCE(d.red_threshold, m.red_threshold) AS red_threshold
    FROM metric_threshold m LEFT JOIN delta d ON d.server_id = m.server_id AND d.metric_name = m.metric_name""")
def merge_latest_threshold(t: Tables):
    high = F.max(F.round("value")).cast("int")
    delta = (
        t.events.filter("value > 100").groupBy(F.col("user_id").alias("server_id"), F.col("event_type").alias("metric_name"))
        .agg(high.alias("amber_threshold"), (high + 20).alias("red_threshold"))
        .withColumn("update_time", F.lit("2024-01-20").cast("timestamp")))
    full = t.metric_threshold.drop("creation_time", "peak")
    return mg.merge_latest(full, delta, ["server_id", "metric_name"]).drop("update_time")


@query("merge_tagged_union", "server server_changes", """
    SELECT 0 AS oc, COUNT(*) AS n, CAST(SUM(memory) AS BIGINT) AS memory FROM server
    UNION ALL SELECT 1, COUNT(*), CAST(SUM(memory) AS BIGINT) FROM server_changes""")
def merge_tagged_union(t: Tables):
    union = mg.tagged_union(t.server, t.server_changes)
    return union.groupBy("oc").agg(F.count("*").alias("n"), F.sum("memory").alias("memory"))


@query("merge_latest_per_key", "changes", f"""
    SELECT id, status, priority, {stamp('update_time')} AS update_time, tie
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY update_time DESC, tie DESC) AS rn FROM changes) WHERE rn = 1""")
def merge_latest_per_key(t: Tables):
    return mg.latest_per_key(t.changes, ["id"], [F.desc("update_time"), F.desc("tie")]).drop("update_date")


@query("merge_upsert", "server server_changes", MERGE_SQL)
def merge_upsert(t: Tables):
    full, delta = full_and_delta(t)
    newest = mg.latest_per_key(delta, ["id"], [F.desc("update_time"), F.desc("tie")])
    return lk.upsert(full, newest, ["id"]).drop("tie")


# one later increment per master table: (rows it covers, changed column, new value, day)
INCREMENTS = {
    "app": ("version >= '1.3'", "version", "'2' || substr(version, 2)", "2024-01-10"),
    "server": ("memory >= 5000", "cpu_cores", "cpu_cores * 2", "2024-01-15"),
    "metric_index": ("name = 'error'", "description", "'new ' || description", "2024-01-20"),
    "metric_threshold": ("peak > 100", "amber_threshold", "amber_threshold + 5", "2024-01-12"),
}
AUDIT_COLUMNS = ["creation_time", "update_time"]


def increment(t: Tables, table: str):
    covered, column, value, day = INCREMENTS[table]
    rows = getattr(t, table).filter(covered).withColumn(column, F.expr(value)).withColumn("update_time", F.expr(f"TIMESTAMP '{day}'"))
    return layers.build_src_master(rows, table, NOW)


def increment_sql(table: str) -> str:
    covered, column, value, day = INCREMENTS[table]
    columns = [f"{value} AS {column}" if c == column else c for c in schemas.ATTRIBUTES[table].names]
    return f"SELECT {', '.join(columns)}, creation_time, TIMESTAMP '{day}' AS update_time FROM {table} WHERE {covered}"


def _dwh_master(table: str) -> None:
    keys = ", ".join(schemas.KEYS[table])
    audit = ", ".join(f"{stamp(c)} AS {c}" for c in AUDIT_COLUMNS)

    @query(f"dwh_{table}", table, f"""
        WITH delta AS ({increment_sql(table)}),
        both_sides AS (
            SELECT {ATTRIBUTE_LISTS[table]}, creation_time, update_time, 0 AS oc FROM {table}
            UNION ALL SELECT {ATTRIBUTE_LISTS[table]}, creation_time, update_time, 1 FROM delta),
        ranked AS (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY update_time DESC, oc DESC) AS rn FROM both_sides)
        SELECT {ATTRIBUTE_LISTS[table]}, {audit}, {NOW_TEXT} FROM ranked WHERE rn = 1""")
    def build(t: Tables):
        full = layers.drop_cols(layers.build_src_master(getattr(t, table), table, NOW), "update_date")
        return layers.build_dwh_master(full, increment(t, table), table, "2024-01-01", "2024-02-01")


for _table in schemas.MASTER_TABLES:
    _dwh_master(_table)


# ---------------------------------------------------------------- slowly changing dimensions

# versions of the changes at day grain: last change per day, repeats dropped
HISTORY_SQL = """
    WITH daily AS (
        SELECT id, status, priority, update_date
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id, update_date ORDER BY tie DESC) AS rn FROM changes) WHERE rn = 1),
    fresh AS (
        SELECT * FROM (
            SELECT *, LAG(status) OVER w AS status_before, LAG(priority) OVER w AS priority_before FROM daily
            WINDOW w AS (PARTITION BY id ORDER BY update_date))
        WHERE status_before IS NULL OR status <> status_before OR priority <> priority_before),
    versions AS (
        SELECT id, status, priority, update_date AS valid_from,
               LEAD(update_date) OVER (PARTITION BY id ORDER BY update_date) AS valid_to FROM fresh)
"""
VERSION_LIST = ("id, status, priority, valid_from || ' 00:00:00.000000' AS valid_from, "
                "valid_to || ' 00:00:00.000000' AS valid_to, valid_to IS NULL AS eff_flag")


@query("scd2_from_history", "changes", HISTORY_SQL + f"""
    SELECT ROW_NUMBER() OVER (ORDER BY id, valid_from) AS dwid, {VERSION_LIST} FROM versions""")
def scd2_from_history(t: Tables):
    return sc.scd2_from_history(t.changes.drop("update_time"), ["id"], latest_by=["tie"])


CUT = "1998-07-01"


# later than any change
OPEN_END = "9999-12-31"


def first_dimension(t: Tables):
    """A dimension holding the changes before the cut."""
    early = t.changes.filter(F.col("update_date") < CUT).drop("update_time")
    return sc.scd2_from_history(early, ["id"], latest_by=["tie"])


# the history up to the cut is numbered first, later versions after it
APPLIED_SQL = HISTORY_SQL + f""",
    numbered AS (
        SELECT *, CASE WHEN valid_from < '{CUT}' THEN 0 ELSE (SELECT COUNT(*) FROM versions WHERE valid_from < '{CUT}') END
                  + ROW_NUMBER() OVER (PARTITION BY valid_from >= '{CUT}' ORDER BY id, valid_from) AS dwid FROM versions)
    SELECT dwid, {VERSION_LIST} FROM numbered"""


@query("scd2_apply", "changes", APPLIED_SQL)
def scd2_apply(t: Tables):
    late = sc.change_set(t.changes, ["id", "status", "priority", "tie"], CUT, OPEN_END)
    return sc.scd2_apply(first_dimension(t), late, ["id"], latest_by=["tie"])


@query("scd2_apply_rerun", "changes", APPLIED_SQL)
def scd2_apply_rerun(t: Tables):
    """Applying the same increments again adds nothing."""
    late = sc.change_set(t.changes, ["id", "status", "priority", "tie"], CUT, OPEN_END)
    once = sc.scd2_apply(first_dimension(t), late, ["id"], latest_by=["tie"])
    return sc.scd2_apply(once, late, ["id"], latest_by=["tie"])


@query("scd2_keep_unchanged", "changes", """
    WITH daily AS (
        SELECT id, status, priority, update_date
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id, update_date ORDER BY tie DESC) AS rn FROM changes) WHERE rn = 1)
    SELECT ROW_NUMBER() OVER (ORDER BY id, update_date) AS dwid, id, status, priority,
           update_date || ' 00:00:00.000000' AS valid_from,
           LEAD(update_date) OVER (PARTITION BY id ORDER BY update_date) || ' 00:00:00.000000' AS valid_to,
           LEAD(update_date) OVER (PARTITION BY id ORDER BY update_date) IS NULL AS eff_flag
    FROM daily""")
def scd2_keep_unchanged(t: Tables):
    return sc.scd2_from_history(t.changes.drop("update_time"), ["id"], latest_by=["tie"], skip_unchanged=False)


# a key of two columns: each customer's versions per priority
@query("scd2_apply_composite", "changes", f"""
    WITH daily AS (
        SELECT id, priority, status, update_date
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id, priority, update_date ORDER BY tie DESC) AS rn FROM changes)
        WHERE rn = 1),
    fresh AS (
        SELECT * FROM (
            SELECT *, LAG(status) OVER (PARTITION BY id, priority ORDER BY update_date) AS before FROM daily)
        WHERE before IS NULL OR status <> before),
    versions AS (
        SELECT id, priority, status, update_date AS valid_from,
               LEAD(update_date) OVER (PARTITION BY id, priority ORDER BY update_date) AS valid_to FROM fresh),
    numbered AS (
        SELECT *, CASE WHEN valid_from < '{CUT}' THEN 0 ELSE (SELECT COUNT(*) FROM versions WHERE valid_from < '{CUT}') END
                  + ROW_NUMBER() OVER (PARTITION BY valid_from >= '{CUT}' ORDER BY id, priority, valid_from) AS dwid FROM versions)
    SELECT dwid, {VERSION_LIST} FROM numbered""")
def scd2_apply_composite(t: Tables):
    keys = ["id", "priority"]
    early = t.changes.filter(F.col("update_date") < CUT).drop("update_time")
    dim = sc.scd2_from_history(early, keys, latest_by=["tie"])
    late = sc.change_set(t.changes, ["id", "priority", "status", "tie"], CUT, OPEN_END)
    return sc.scd2_apply(dim, late, keys, latest_by=["tie"])


def compat_inputs(t: Tables):
    """A dimension of one version per server, and all changes of one quarter."""
    dim = t.dim_server.filter("eff_flag").select(
        "dwid", "id", F.col("hostname").alias("status"), F.lit("none").alias("priority"), "valid_from", "valid_to", "eff_flag")
    return dim, sc.change_set(t.changes, ["id", "status", "priority"], "2001-01-01", "2001-04-01")


COMPAT_VIEWS = "changes dim_server"
COMPAT_SQL = """
    WITH u AS (
        SELECT id, status, priority, update_date FROM changes
        WHERE update_date >= '2001-01-01' AND update_date < '2001-04-01'),
    m AS (
        SELECT dwid, id, hostname AS status, 'none' AS priority, valid_from, valid_to, eff_flag FROM dim_server WHERE eff_flag),
    closed AS (
        SELECT m.dwid, m.id, m.status, m.priority, m.valid_from,
               CASE WHEN m.eff_flag AND u.id IS NOT NULL THEN CAST(u.update_date AS TIMESTAMP) ELSE m.valid_to END AS valid_to,
               CASE WHEN m.eff_flag AND u.id IS NOT NULL THEN FALSE ELSE m.eff_flag END AS eff_flag
        FROM m LEFT JOIN u ON u.id = m.id)
"""
CLOSED_LIST = f"dwid, id, status, priority, {stamp('valid_from')} AS valid_from, {stamp('valid_to')} AS valid_to, eff_flag"


@query("scd2_compat", COMPAT_VIEWS, COMPAT_SQL + f""",
    opened AS (
        SELECT (SELECT COALESCE(MAX(dwid), 0) FROM m) + ROW_NUMBER() OVER (ORDER BY id, update_date, status, priority) AS dwid,
               id, status, priority, CAST(update_date AS TIMESTAMP) AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS eff_flag
        FROM u)
    SELECT {CLOSED_LIST} FROM closed UNION ALL SELECT {CLOSED_LIST} FROM opened""")
def scd2_compat(t: Tables):
    dim, changes = compat_inputs(t)
    return sc.scd2_apply(dim, changes, ["id"], compat=True)


@query("scd2_close_matched", COMPAT_VIEWS, COMPAT_SQL + f"SELECT {CLOSED_LIST} FROM closed")
def scd2_close_matched(t: Tables):
    dim, changes = compat_inputs(t)
    return sc.close_matched(sc.match_changes(dim, changes, ["id"]))


@query("scd2_match_changes", COMPAT_VIEWS, COMPAT_SQL + """
    SELECT m.id, u.update_date AS changed_on, COUNT(*) AS n FROM m LEFT JOIN u ON u.id = m.id GROUP BY m.id, u.update_date""")
def scd2_match_changes(t: Tables):
    dim, changes = compat_inputs(t)
    matched = sc.match_changes(dim, changes, ["id"])
    return matched.groupBy("id", F.col(sc.MATCHED).alias("changed_on")).agg(F.count("*").alias("n"))


@query("scd2_union_versions", COMPAT_VIEWS, COMPAT_SQL + """
    SELECT id, COUNT(*) AS versions, CAST(COUNT(*) FILTER (eff_flag) AS BIGINT) AS open_versions FROM (
        SELECT id, eff_flag FROM closed UNION ALL SELECT id, TRUE FROM u) GROUP BY id""")
def scd2_union_versions(t: Tables):
    dim, changes = compat_inputs(t)
    closed = sc.close_matched(sc.match_changes(dim, changes, ["id"]))
    opened = sc.open_versions(changes).withColumn("dwid", F.lit(None).cast("long"))
    return sc.union_versions(closed, opened).groupBy("id").agg(
        F.count("*").alias("versions"), F.count_if("eff_flag").alias("open_versions"))


@query("scd2_max_key", "dim_server", "SELECT COALESCE(MAX(dwid), 0) AS max_id FROM dim_server")
def scd2_max_key(t: Tables):
    return max_key(t.dim_server)


@query("scd2_with_max_key", "changes dim_server", """
    SELECT id, status, tie, (SELECT COALESCE(MAX(dwid), 0) FROM dim_server) AS max_id FROM changes""")
def scd2_with_max_key(t: Tables):
    return sc.with_max_key(t.changes.select("id", "status", "tie"), t.dim_server)


@query("scd2_assign_dwid", "changes dim_server", """
    SELECT (SELECT MAX(dwid) FROM dim_server) + ROW_NUMBER() OVER (ORDER BY id, update_time, tie) AS dwid, id, tie FROM changes""")
def scd2_assign_dwid(t: Tables):
    highest = max_key(t.dim_server).first()["max_id"]
    return number_rows(t.changes, ["id", "update_time", "tie"], highest).select("dwid", "id", "tie")


def _dimension(table: str) -> None:
    """First load of a dimension from its source rows, then one later increment."""
    keys = ", ".join(schemas.KEYS[table])
    columns = ATTRIBUTE_LISTS[table]
    day = INCREMENTS[table][3]

    sql = f"""
        WITH delta AS ({increment_sql(table)}),
        first_load AS (
            SELECT ROW_NUMBER() OVER (ORDER BY {keys}) AS dwid, {columns}, date_trunc('day', update_time) AS valid_from
            FROM {table}),
        versions AS (
            SELECT *, CASE WHEN ({keys}) IN (SELECT ({keys}) FROM delta) THEN TIMESTAMP '{day}' END AS valid_to FROM first_load
            UNION ALL
            SELECT (SELECT MAX(dwid) FROM first_load) + ROW_NUMBER() OVER (ORDER BY {keys}), {columns},
                   TIMESTAMP '{day}', NULL FROM delta)
        SELECT dwid, {columns}, {stamp('valid_from')} AS valid_from, {stamp('valid_to')} AS valid_to, valid_to IS NULL AS eff_flag
        FROM versions"""

    @query(f"dim_{table}", table, sql)
    def build(t: Tables):
        src = layers.build_src_master(getattr(t, table), table, NOW)
        empty = t.spark.createDataFrame([], schemas.DIM[table])
        loaded = marts.build_dim(empty, src, table, "1990-01-01", "2024-01-01")
        return marts.build_dim(loaded, increment(t, table), table, "2024-01-01", "2024-02-01")

    @query(f"stored_dim_{table}", table, sql)
    def build_stored(t: Tables):
        """The same dimension as the warehouse stores it, by bucket and ended year."""
        wh = daily.Warehouse(t.spark, fresh_path(t.spark, "warehouse"), buckets=8)
        src = layers.build_src_master(getattr(t, table), table, NOW)
        wh.apply(table, marts.dim_changes(src, table, "1990-01-01", "2024-01-01"))
        wh.apply(table, marts.dim_changes(increment(t, table), table, "2024-01-01", "2024-02-01"))
        return wh.current("dmt", f"dim_{table}")


for _table in schemas.MASTER_TABLES:
    _dimension(_table)


# ---------------------------------------------------------------- joins

VALID = "({ts} >= {d}.valid_from AND ({ts} < {d}.valid_to OR {d}.valid_to IS NULL))"


def valid(dim: str, ts: str = 'm."timestamp"') -> str:
    return VALID.format(ts=ts, d=dim)


@query("join_server_at_event", "metric dim_server", f"""
    SELECT m.id, s.dwid AS server_dwid, s.app_id FROM metric m JOIN dim_server s ON s.hostname = m.hostname AND {valid('s')}""")
def join_server_at_event(t: Tables):
    joined = j.pit_join(t.metric, t.dim_server, {"hostname": "hostname"}, {"server_dwid": "dwid", "app_id": "app_id"})
    return joined.select("id", "server_dwid", "app_id")


@query("join_server_shuffled", "metric dim_server", f"""
    SELECT m.id, s.dwid AS server_dwid, s.app_id FROM metric m JOIN dim_server s ON s.hostname = m.hostname AND {valid('s')}""")
def join_server_shuffled(t: Tables):
    """The same join as it runs when the dimension is too large to broadcast."""
    joined = j.pit_join(t.metric, t.dim_server, {"hostname": "hostname"}, {"server_dwid": "dwid", "app_id": "app_id"},
                        limit=0)
    return joined.select("id", "server_dwid", "app_id")


@query("join_app_lifted", "metric dim_server dim_app", f"""
    SELECT m.id, s.dwid AS server_dwid, a.dwid AS app_dwid
    FROM metric m JOIN dim_server s ON s.hostname = m.hostname AND {valid('s')}
    JOIN dim_app a ON a.id = s.app_id AND {valid('a')}""")
def join_app_lifted(t: Tables):
    hosts = j.lift_dimension(t.dim_server, t.dim_app, {"app_id": "id"}, {"app_dwid": "dwid"})
    joined = j.pit_join(t.metric, hosts, {"hostname": "hostname"}, {"server_dwid": "dwid", "app_dwid": "app_dwid"})
    return joined.select("id", "server_dwid", "app_dwid")


@query("join_metric_index_at_event", "metric dim_metric_index", f"""
    SELECT m.id, i.dwid AS metric_index_dwid FROM metric m JOIN dim_metric_index i ON i.name = m.name AND {valid('i')}""")
def join_metric_index_at_event(t: Tables):
    return j.pit_join(t.metric, t.dim_metric_index, {"name": "name"}, {"metric_index_dwid": "dwid"}).select("id", "metric_index_dwid")


@query("join_hour_key", "metric dim_hour", """
    SELECT m.id, h.dwid AS hour_dwid FROM metric m JOIN dim_hour h ON h.db_hour = date_trunc('hour', m."timestamp")""")
def join_hour_key(t: Tables):
    return j.with_hour_key(t.metric, t.dim_hour).select("id", "hour_dwid")


@query("join_unmatched_facts", "metric dim_server", f"""
    SELECT m.id, m.hostname FROM metric m
    WHERE NOT EXISTS (SELECT 1 FROM dim_server s WHERE s.hostname = m.hostname AND {valid('s')})""")
def join_unmatched_facts(t: Tables):
    return j.unmatched_facts(t.metric, t.dim_server, {"hostname": "hostname"}).select("id", "hostname")


SUMMARY_VIEWS = "metric dim_server dim_app dim_metric_index dim_metric_threshold dim_hour"
FACT_SQL = f"""
    WITH fact AS MATERIALIZED (
        SELECT m.id, a.dwid AS app_dwid, s.dwid AS server_dwid, i.dwid AS metric_index_dwid, h.dwid AS hour_dwid,
               m."timestamp", m.value, m.creation_date
        FROM metric m
        JOIN dim_server s ON s.hostname = m.hostname AND {valid('s')}
        JOIN dim_app a ON a.id = s.app_id AND {valid('a')}
        JOIN dim_metric_index i ON i.name = m.name AND {valid('i')}
        JOIN dim_hour h ON h.db_hour = date_trunc('hour', m."timestamp"))
"""
DAY = "CAST(g.creation_date AS TIMESTAMP)"
SUMMARY_SQL = FACT_SQL + f""",
    means AS MATERIALIZED (
        SELECT creation_date, app_dwid, server_dwid, metric_index_dwid, hour_dwid, CAST(ROUND(AVG(value)) AS INTEGER) AS avg_value
        FROM fact GROUP BY creation_date, app_dwid, server_dwid, metric_index_dwid, hour_dwid),
    summary AS MATERIALIZED (
        SELECT g.app_dwid, g.server_dwid, g.metric_index_dwid, t.dwid AS metric_threshold_dwid, g.hour_dwid, g.avg_value,
               CASE WHEN g.avg_value < t.amber_threshold THEN 'GREEN' WHEN g.avg_value > t.red_threshold THEN 'RED'
                    ELSE 'AMBER' END AS rag, g.creation_date
        FROM means g
        JOIN dim_server s ON s.dwid = g.server_dwid AND {valid('s', DAY)}
        JOIN dim_metric_index i ON i.dwid = g.metric_index_dwid AND {valid('i', DAY)}
        JOIN dim_metric_threshold t ON t.server_id = s.id AND t.metric_name = i.name AND {valid('t', DAY)})
"""


def fact(t: Tables):
    return marts.build_fact_metric(t.dated_metric, t.dims, *t.days)


def summary(t: Tables):
    return marts.build_sum_metric_avg(fact(t), t.dims, *t.days)


@query("fact_metric", SUMMARY_VIEWS, FACT_SQL + f"""
    SELECT id, app_dwid, server_dwid, metric_index_dwid, hour_dwid, {stamp('"timestamp"')} AS "timestamp", value, creation_date
    FROM fact""")
def fact_metric(t: Tables):
    return fact(t)


@query("fact_metric_shuffled", SUMMARY_VIEWS, FACT_SQL + f"""
    SELECT id, app_dwid, server_dwid, metric_index_dwid, hour_dwid, {stamp('"timestamp"')} AS "timestamp", value, creation_date
    FROM fact""")
def fact_metric_shuffled(t: Tables):
    """The fact built without any broadcast, hot keys split."""
    return marts.build_fact_metric(t.dated_metric, t.dims, *t.days, limit=0)


@query("sum_metric_avg", SUMMARY_VIEWS, SUMMARY_SQL + "SELECT * FROM summary")
def sum_metric_avg(t: Tables):
    return summary(t)


@query("join_server_at_day_start", SUMMARY_VIEWS, FACT_SQL + """,
    means AS (SELECT DISTINCT creation_date, server_dwid FROM fact)
    SELECT g.creation_date, g.server_dwid, s.id AS server_id FROM means g JOIN dim_server s ON s.dwid = g.server_dwid
    AND CAST(g.creation_date AS TIMESTAMP) >= s.valid_from AND (CAST(g.creation_date AS TIMESTAMP) < s.valid_to OR s.valid_to IS NULL)""")
def join_server_at_day_start(t: Tables):
    days = fact(t).select("creation_date", "server_dwid").distinct()
    return j.asof_date_join(days, t.dim_server, {"server_dwid": "dwid"}, {"server_id": "id"})


@query("join_threshold_at_day_start", "metric dim_metric_threshold", """
    WITH days AS (SELECT DISTINCT creation_date, user_id AS server_id, name AS metric_name FROM metric)
    SELECT d.creation_date, d.server_id, d.metric_name, t.dwid AS metric_threshold_dwid, t.red_threshold
    FROM days d JOIN dim_metric_threshold t ON t.server_id = d.server_id AND t.metric_name = d.metric_name
    AND CAST(d.creation_date AS TIMESTAMP) >= t.valid_from AND (CAST(d.creation_date AS TIMESTAMP) < t.valid_to OR t.valid_to IS NULL)""")
def join_threshold_at_day_start(t: Tables):
    days = t.dated_metric.select(
        "creation_date", F.expr("CAST(substring(hostname, 4) AS BIGINT)").alias("server_id"), F.col("name").alias("metric_name"),
    ).distinct()
    return j.asof_date_join(days, t.dim_metric_threshold, {"server_id": "server_id", "metric_name": "metric_name"},
                            {"metric_threshold_dwid": "dwid", "red_threshold": "red_threshold"})


STAR_LIST = """a.dwid AS app_dwid, a.name AS app_name, a.description AS app_description, a.version AS app_version,
       s.dwid AS server_dwid, s.hostname AS server_hostname, s.cpu_cores AS server_cpu_cores, s.memory AS server_memory,
       i.dwid AS metric_index_dwid, i.name AS metric_name, i.description AS metric_description, i.category AS metric_category,
       h.dwid AS hour_dwid, h.db_date, """ + stamp("h.db_hour") + """ AS db_hour, h."year", h."month", h."day", h."hour",
       h."quarter", h.week, h.day_name, h.month_name, h.weekend_flag, g.rag, g.creation_date"""
STAR_JOINS = """FROM summary g JOIN dim_app a ON a.dwid = g.app_dwid JOIN dim_server s ON s.dwid = g.server_dwid
    JOIN dim_metric_index i ON i.dwid = g.metric_index_dwid JOIN dim_hour h ON h.dwid = g.hour_dwid"""
THRESHOLD_LIST = "t.dwid AS metric_threshold_dwid, t.amber_threshold, t.red_threshold, CAST(g.avg_value AS BIGINT) AS avg_value"


@query("wide_metric_avg", SUMMARY_VIEWS, SUMMARY_SQL + f"""
    SELECT {STAR_LIST}, {THRESHOLD_LIST} {STAR_JOINS} JOIN dim_metric_threshold t ON t.dwid = g.metric_threshold_dwid
    WHERE g.creation_date >= '2024-01-08' AND g.creation_date < '2024-01-22'""")
def wide_metric_avg(t: Tables):
    return marts.build_wide_metric_avg(summary(t), t.dims, "2024-01-08", "2024-01-22")


@query("wide_metric_avg_compat", SUMMARY_VIEWS, SUMMARY_SQL + f"""
    SELECT {STAR_LIST}, {THRESHOLD_LIST} {STAR_JOINS}
    JOIN dim_metric_threshold t ON t.server_id = s.id AND t.metric_name = i.name
    WHERE g.creation_date >= '2024-01-08' AND g.creation_date <= '2024-01-22'""")
def wide_metric_avg_compat(t: Tables):
    return marts.build_wide_metric_avg(summary(t), t.dims, "2024-01-08", "2024-01-22", compat=True)


@query("join_star", SUMMARY_VIEWS, SUMMARY_SQL + f"SELECT {STAR_LIST}, s.id AS server_id, g.avg_value, g.metric_threshold_dwid {STAR_JOINS}")
def join_star(t: Tables):
    return j.star_join(summary(t), t.dims)


@query("join_threshold", SUMMARY_VIEWS, SUMMARY_SQL + """
    SELECT g.server_dwid, g.metric_threshold_dwid, g.hour_dwid, t.amber_threshold, t.red_threshold
    FROM summary g JOIN dim_metric_threshold t ON t.dwid = g.metric_threshold_dwid""")
def join_threshold(t: Tables):
    rows = summary(t).select("server_dwid", "metric_threshold_dwid", "hour_dwid")
    return j.threshold_join(rows, t.dim_metric_threshold)


@query("join_delete_keys", "server", f"""
    SELECT {SERVER_LIST} FROM server WHERE id NOT IN (SELECT user_id FROM events)""")
def join_delete_keys(t: Tables):
    gone = t.events.select(F.col("user_id").alias("id"))
    return j.delete_keys(t.server.drop("creation_time"), gone, ["id"])


BUILD_SQL = """
    WITH server_dim AS (
        SELECT ROW_NUMBER() OVER (ORDER BY id) AS dwid, *, creation_time + to_days(CAST(app_id AS INTEGER)) AS vf FROM server),
    server_dim2 AS (
        SELECT dwid, id, app_id, hostname, cpu_cores, memory, vf AS valid_from,
               CASE WHEN memory >= 5000 THEN TIMESTAMP '2024-01-15' END AS valid_to FROM server_dim
        UNION ALL
        SELECT (SELECT MAX(dwid) FROM server_dim) + ROW_NUMBER() OVER (ORDER BY id), id, app_id, hostname, cpu_cores * 2, memory,
               TIMESTAMP '2024-01-15', NULL FROM server_dim WHERE memory >= 5000),
    app_dim AS (SELECT ROW_NUMBER() OVER (ORDER BY id) AS dwid, * FROM app),
    index_dim AS (SELECT ROW_NUMBER() OVER (ORDER BY id) AS dwid, * FROM metric_index),
    threshold_dim AS (SELECT ROW_NUMBER() OVER (ORDER BY server_id, metric_name) AS dwid, * FROM metric_threshold),
    means AS MATERIALIZED (
        SELECT m.creation_date, date_trunc('hour', m."timestamp") AS h, a.dwid AS app_dwid, a.name AS app_name,
               s.dwid AS server_dwid, s.id AS server_id, s.cpu_cores, i.dwid AS metric_index_dwid, i.name AS metric_name,
               CAST(ROUND(AVG(m.value)) AS INTEGER) AS avg_value
        FROM metric m
        JOIN server_dim2 s ON s.hostname = m.hostname AND m."timestamp" >= s.valid_from
            AND (m."timestamp" < s.valid_to OR s.valid_to IS NULL)
        JOIN app_dim a ON a.id = s.app_id JOIN index_dim i ON i.name = m.name
        GROUP BY ALL)
    SELECT g.app_dwid, g.app_name, g.server_dwid, g.cpu_cores AS server_cpu_cores, g.metric_index_dwid, g.metric_name,
           t.dwid AS metric_threshold_dwid, t.red_threshold, CAST(strftime(g.h, '%Y%m%d%H') AS BIGINT) AS hour_dwid,
           strftime(g.h, '%A') AS day_name, CAST(g.avg_value AS BIGINT) AS avg_value,
           CASE WHEN g.avg_value < t.amber_threshold THEN 'GREEN' WHEN g.avg_value > t.red_threshold THEN 'RED'
                ELSE 'AMBER' END AS rag, g.creation_date
    FROM means g JOIN threshold_dim t ON t.server_id = g.server_id AND t.metric_name = g.metric_name"""
BUILD_VIEWS = "metric server app metric_index metric_threshold"


def build_all(t: Tables, build):
    """Two builds into one warehouse: everything up to mid January, then the rest with server upgrades."""
    first, last = min(t.days[0], "1995-01-01"), max(t.days[1], "2024-01-16")
    wh = daily.Warehouse(t.spark, fresh_path(t.spark, "warehouse"), buckets=8)
    # servers change in one batch per app, so the increments fill few date partitions
    server = t.server.withColumn("update_time", F.expr("creation_time + make_dt_interval(CAST(app_id AS INT))"))
    master = {"app": t.app, "server": server, "metric_index": t.metric_index, "metric_threshold": t.metric_threshold.drop("peak")}
    half = F.lit("2024-01-15").cast("timestamp")
    build(wh, {**master, "metric": t.metric.filter(F.col("timestamp") < half)}, first, "2024-01-15", NOW,
                    calendar=tuple(f"{day} 00:00:00" for day in t.days))
    upgraded = server.filter("memory >= 5000").withColumn("cpu_cores", F.col("cpu_cores") * 2).withColumn("update_time", half)
    nothing = {n: t.spark.createDataFrame([], schemas.MASTER[n]) for n in master}
    second = {**nothing, "server": upgraded, "metric": t.metric.filter(F.col("timestamp") >= half)}
    build(wh, second, "2024-01-15", last, NOW)
    wide = daily.Published(wh).range("dmt", "wide_metric_avg", first, last)
    return wide.select("app_dwid", "app_name", "server_dwid", "server_cpu_cores", "metric_index_dwid", "metric_name",
                       "metric_threshold_dwid", "red_threshold", "hour_dwid", "day_name", "avg_value", "rag", "creation_date")


@query("build_day", BUILD_VIEWS, BUILD_SQL)
def build_day(t: Tables):
    return build_all(t, daily.build_day)


@query("build_day_continued", BUILD_VIEWS, BUILD_SQL)
def build_day_continued(t: Tables):
    """The same builds, each stopped on the way and continued."""
    class Stopped(Exception):
        pass

    def stop(step):
        if step in ("server/dwh", "metric/fact"):
            raise Stopped(step)

    def build(*args, **options):
        for on_step in (stop, stop, None):
            try:
                daily.build_day(*args, **options, on_step=on_step)
            except Stopped:
                continue

    return build_all(t, build)


# ---------------------------------------------------------------- ratings, aggregates, lookups

MEAN_SQL = """
    WITH means AS (
        SELECT user_id AS server_id, name, date_trunc('day', "timestamp") AS day_start, CAST(ROUND(AVG(value)) AS INTEGER) AS avg_value
        FROM metric GROUP BY 1, 2, 3)
"""


def daily_means(t: Tables):
    means = agg.hourly_mean(t.metric, ["hostname", "name"], grain="day")
    return means.withColumn("server_id", F.expr("CAST(substring(hostname, 4) AS BIGINT)"))


@query("agg_hourly_mean", "metric", f"""
    SELECT hostname, name, {stamp('hour_start')} AS hour_start, avg_value FROM (
        SELECT hostname, name, date_trunc('hour', "timestamp") AS hour_start, CAST(ROUND(AVG(value)) AS INTEGER) AS avg_value
        FROM metric GROUP BY 1, 2, 3)""")
def agg_hourly_mean(t: Tables):
    return agg.hourly_mean(t.metric, ["hostname", "name"], grain="hour")


RAG_SQL = MEAN_SQL + """
    SELECT m.server_id, m.name, strftime(m.day_start, '%Y-%m-%d') AS day, m.avg_value,
           CASE WHEN avg_value < amber_threshold THEN 'GREEN' WHEN avg_value > red_threshold THEN 'RED' ELSE 'AMBER' END AS rag
    FROM means m JOIN metric_threshold t ON t.server_id = m.server_id AND t.metric_name = m.name"""


def rated(t: Tables):
    means = daily_means(t).withColumn("day", F.date_format("day_start", "yyyy-MM-dd"))
    on = {"server_id": "server_id", "name": "metric_name"}
    return j.attach(means, t.metric_threshold, on, j.THRESHOLD_COLUMNS)


@query("rag_batch", "metric metric_threshold", RAG_SQL)
def rag_batch(t: Tables):
    rag = gen_rag("avg_value", "amber_threshold", "red_threshold")
    return rated(t).select("server_id", "name", "day", "avg_value", rag.alias("rag"))


@query("rag_sql_function", "metric metric_threshold", RAG_SQL)
def rag_sql_function(t: Tables):
    register_gen_rag(t.spark)
    return rated(t).selectExpr("server_id", "name", "day", "avg_value", "gen_rag(avg_value, amber_threshold, red_threshold) AS rag")


@query("rag_stream_severity", "metric metric_threshold", MEAN_SQL + """
    SELECT m.server_id, m.name, strftime(m.day_start, '%Y-%m-%d') AS day,
           CASE WHEN avg_value < amber_threshold THEN 0 WHEN avg_value >= red_threshold THEN 2 ELSE 1 END AS severity,
           CASE WHEN avg_value < amber_threshold THEN 'GREEN' WHEN avg_value >= red_threshold THEN 'RED' ELSE 'AMBER' END AS label
    FROM means m JOIN metric_threshold t ON t.server_id = m.server_id AND t.metric_name = m.name""")
def rag_stream_severity(t: Tables):
    level = severity("avg_value", "amber_threshold", "red_threshold")
    return rated(t).select("server_id", "name", "day", level.alias("severity"), severity_label(level).alias("label"))


@query("agg_nest_thresholds", "metric_threshold", """
    SELECT server_id, metric_name, amber_threshold, red_threshold FROM metric_threshold""")
def agg_nest_thresholds(t: Tables):
    nested = agg.nest_thresholds(t.metric_threshold)
    flat = nested.select("server_id", F.explode("metric_thresholds").alias("metric_name", "entry"))
    return flat.select("server_id", "metric_name", F.col("entry.amberThreshold").alias("amber_threshold"),
                       F.col("entry.redThreshold").alias("red_threshold"))


@query("agg_servers_by_app", "server", """
    SELECT app_id, COUNT(*) AS n, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS server_ids
    FROM server GROUP BY app_id""")
def agg_servers_by_app(t: Tables):
    """The whole set of each app, put together from its (app, id) rows."""
    members = agg.servers_by_app(t.server)
    ids = F.sort_array(F.collect_list("server_id"))
    return members.groupBy("app_id").agg(F.count("*").alias("n"), F.array_join(ids.cast("array<string>"), ",").alias("server_ids"))


@query("lookup_by_id", "server", f"SELECT {SERVER_LIST} FROM server WHERE id IN (SELECT user_id FROM events)")
def lookup_by_id(t: Tables):
    return lk.lookup_by_id(t.server.drop("creation_time"), t.events.select(F.col("user_id").alias("id")))


@query("lookup_by_name", "server", f"""
    SELECT {SERVER_LIST} FROM server WHERE hostname IN (SELECT 'svr' || user_id FROM events WHERE event_type = 'error')""")
def lookup_by_name(t: Tables):
    return lk.lookup_by_name(t.server.drop("creation_time"), t.metric.filter("name = 'error'"), "hostname")


@query("lookup_list_all", "app", "SELECT id, name, description, version FROM app")
def lookup_list_all(t: Tables):
    return lk.list_all(t.app).drop("creation_time", "update_time")


SNAPSHOT_SQL = """
    SELECT s.id, s.hostname, t.amber_threshold, t.red_threshold
    FROM server s LEFT JOIN metric_threshold t ON t.server_id = s.id AND t.metric_name = 'click'"""


@query("lookup_server_snapshot", "server metric_threshold", SNAPSHOT_SQL)
def lookup_server_snapshot(t: Tables):
    """The nested snapshot, read back through the map of one metric."""
    entry = lk.threshold_of(metric_key(F.lit("click")))
    return lk.server_snapshot(t.server, t.metric_threshold).select(
        "id", "hostname", entry["amberThreshold"].alias("amber_threshold"), entry["redThreshold"].alias("red_threshold"))


@query("lookup_metric_thresholds", "server metric_threshold", SNAPSHOT_SQL.replace("LEFT JOIN", "JOIN").replace("s.id,", "s.id AS server_id,"))
def lookup_metric_thresholds(t: Tables):
    return lk.metric_thresholds(t.server, t.metric_threshold, "click")


@query("enrich_server", "metric server", """
    SELECT m.id, s.id AS server_id FROM metric m LEFT JOIN server s ON s.hostname = m.hostname""")
def enrich_server(t: Tables):
    return j.enrich_server(t.metric, t.server.withColumnRenamed("id", "server_id")).select("id", "server_id")


@query("enrich_alert", "alert alert_index", """
    SELECT a.id, i.id AS alert_id, i.severity FROM alert a LEFT JOIN alert_index i ON i.name = a.message""")
def enrich_alert(t: Tables):
    return j.enrich_alert(t.alert, t.alert_index).select("id", "alert_id", "severity")


@query("enrich_metric_name", sql="""
    SELECT event_id AS id, replace(event_type || '_usage', '_', '.') AS metric_name FROM events""")
def enrich_metric_name(t: Tables):
    name = metric_key(F.concat("event_type", F.lit("_usage")))
    return t.events.select(F.col("event_id").alias("id"), name.alias("metric_name"))


@query("enrich_state_key", sql="""
    SELECT user_id AS server_id, CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp",
           printf('%016X%016X', user_id, CAST(floor(epoch(ts)) AS BIGINT)) AS row_key
    FROM events""")
def enrich_state_key(t: Tables):
    rows = t.events.select(F.col("user_id").alias("server_id"), F.unix_timestamp("ts").alias("timestamp"))
    return rows.withColumn("row_key", state_key("server_id", "timestamp"))


@query("preview", "metric", 'SELECT id, name, hostname, value FROM metric ORDER BY value DESC, id LIMIT 10')
def preview(t: Tables):
    return lk.preview(t.metric.select("id", "name", "hostname", "value"), 10, [F.desc("value"), "id"])
