"""The monitoring tables as views over the test tables, once as DataFrames and once as SQL text."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry import schemas
from beaconry.functions.times import date_string
from beaconry.operators.calendar import hours_between

EVENTS = schemas.struct(event_id=schemas.LONG, ts=schemas.TS, user_id=schemas.LONG, event_type=schemas.STR,
                        value=schemas.T.DoubleType(), props=schemas.STR)
CUSTOMER = schemas.struct(c_custkey=schemas.LONG, c_name=schemas.STR, c_nationkey=schemas.INT,
                          c_acctbal=schemas.T.DoubleType(), c_mktsegment=schemas.STR)
NATION = schemas.struct(n_nationkey=schemas.INT, n_name=schemas.STR, n_regionkey=schemas.INT)
ORDERS = schemas.struct(o_orderkey=schemas.LONG, o_custkey=schemas.LONG, o_orderstatus=schemas.STR,
                        o_totalprice=schemas.T.DoubleType(), o_orderdate=schemas.TS, o_orderpriority=schemas.STR)

NOW = "2024-02-01 00:00:00"


def _ts(text: str):
    return F.expr(f"TIMESTAMP '{text}'")


class Tables:
    """Views over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _read(self, name: str, schema) -> DataFrame:
        # the files hold times without a zone; the declared schema reads them as UTC instants,
        # which keeps time filters pushable
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def days(self) -> tuple[str, str]:
        """The days the event table covers, the second one excluded."""
        ends = self.events.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).select(
            date_string("low").alias("low"), date_string(F.col("high") + F.expr("INTERVAL 1 DAY")).alias("high")).first()
        return (ends.low, ends.high) if ends.low else ("1970-01-01", "1970-01-02")

    def events_stream(self) -> DataFrame:
        # a pattern, because the file source wants a folder or a pattern
        return self.spark.readStream.schema(EVENTS).parquet(f"{self.folder}/events.parque[t]")

    @cached_property
    def events(self) -> DataFrame:
        return self._read("events", EVENTS)

    @cached_property
    def orders(self) -> DataFrame:
        return self._read("orders", ORDERS)

    @cached_property
    def customer(self) -> DataFrame:
        return self._read("customer", CUSTOMER)

    @cached_property
    def nation(self) -> DataFrame:
        return self._read("nation", NATION)

    # ------------------------------------------------------------ source tables

    @staticmethod
    def as_metric(events: DataFrame) -> DataFrame:
        return events.select(
            F.col("event_id").alias("id"), F.col("event_type").alias("name"),
            F.concat(F.lit("svr"), "user_id").alias("hostname"),
            F.round("value").cast("long").alias("value"), F.col("ts").alias("timestamp"),
        )

    @staticmethod
    def as_alert(events: DataFrame) -> DataFrame:
        kinds = events.filter(F.col("event_type").isin("error", "signup"))
        return kinds.select(
            F.col("event_id").alias("id"),
            F.concat(F.lit("alert type "), F.col("user_id") % 3).alias("message"),
            F.concat(F.lit("svr"), "user_id").alias("hostname"),
            F.when(F.col("event_type") == "error", "OPEN").otherwise("CLOSED").alias("status"),
            F.date_trunc("day", "ts").alias("timestamp"),
            F.col("ts").alias("created_time"),
        )

    @property
    def metric(self) -> DataFrame:
        return self.as_metric(self.events)

    @property
    def dated_metric(self) -> DataFrame:
        return self.metric.withColumn("creation_date", date_string("timestamp"))

    @property
    def alert(self) -> DataFrame:
        return self.as_alert(self.events)

    @cached_property
    def alert_index(self) -> DataFrame:
        kinds = self.events.select((F.col("user_id") % 3).alias("id")).distinct()
        return kinds.select(
            "id", F.concat(F.lit("alert type "), "id").alias("name"), F.col("id").cast("int").alias("severity"))

    @cached_property
    def app(self) -> DataFrame:
        return self.nation.select(
            F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"),
            F.concat(F.lit("app of region "), "n_regionkey").alias("description"),
            F.concat(F.lit("1."), "n_regionkey").alias("version"),
            _ts("1995-01-01").alias("creation_time"), _ts("1995-01-01").alias("update_time"),
        )

    @cached_property
    def server(self) -> DataFrame:
        days = (F.col("c_custkey") % 2400).cast("int")
        return self.customer.select(
            F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("long").alias("app_id"),
            F.concat(F.lit("svr"), "c_custkey").alias("hostname"),
            (F.col("c_custkey") % 16 + 1).cast("int").alias("cpu_cores"),
            F.floor("c_acctbal").cast("int").alias("memory"),
            _ts("1995-01-01").alias("creation_time"),
            F.date_add(F.lit("1995-01-01").cast("date"), days).cast("timestamp").alias("update_time"),
        )

    @staticmethod
    def kind_id(name: str = "name"):
        return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long")

    @cached_property
    def metric_index(self) -> DataFrame:
        kinds = self.events.select(F.col("event_type").alias("name")).distinct()
        return kinds.select(
            self.kind_id().alias("id"), "name", F.concat(F.lit("value of "), "name").alias("description"),
            F.substring("name", 1, 1).alias("category"),
            _ts("1995-01-01").alias("creation_time"), _ts("1995-01-01").alias("update_time"),
        )

    @cached_property
    def metric_threshold(self) -> DataFrame:
        """One row per observed (server, metric); ``peak`` is its largest value."""
        seen = self.events.groupBy(F.col("user_id").alias("server_id"), F.col("event_type").alias("metric_name")).agg(
            F.max("value").alias("peak"))
        amber = (F.lit(40) + F.col("server_id") % 10).cast("int")
        return seen.select(
            "server_id", "metric_name", amber.alias("amber_threshold"), (amber + 15).alias("red_threshold"),
            _ts("1995-01-01").alias("creation_time"), _ts("1995-01-01").alias("update_time"), "peak",
        )

    @property
    def changes(self) -> DataFrame:
        """Server changes, several per server and now and then on one day; ``tie`` orders those."""
        return self.orders.select(
            F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").alias("update_time"),
            F.col("o_orderkey").alias("tie"), date_string("o_orderdate").alias("update_date"),
        )

    @property
    def server_changes(self) -> DataFrame:
        """The changes in the shape of the server table."""
        return self.orders.select(
            F.col("o_custkey").alias("id"), (F.col("o_orderkey") % 25).alias("app_id"),
            F.concat(F.lit("svr"), "o_custkey").alias("hostname"),
            (F.col("o_orderkey") % 64 + 1).cast("int").alias("cpu_cores"),
            F.floor("o_totalprice").cast("int").alias("memory"),
            _ts("1995-01-01").alias("creation_time"), F.col("o_orderdate").alias("update_time"),
            F.col("o_orderkey").alias("tie"),
        )

    # ------------------------------------------------------------ dimensions

    @staticmethod
    def _versioned(df: DataFrame, columns: list[str], dwid: str, first: str, cut: str, changed: str,
                   renewed: dict[str, str]) -> DataFrame:
        """A first version of each row and, where ``changed``, a second one from ``cut`` on."""

        def version(number, values, valid_from, valid_to, eff_flag):
            fields = [f"{values.get(c, c)} AS {c}" for c in columns]
            return (f"struct(({dwid}) * 2 + {number} AS dwid, {', '.join(fields)}, {valid_from} AS valid_from, "
                    f"CAST({valid_to} AS TIMESTAMP) AS valid_to, {eff_flag} AS eff_flag)")

        one = version(1, {}, first, f"CASE WHEN {changed} THEN TIMESTAMP '{cut}' END", f"NOT ({changed})")
        two = version(2, renewed, f"TIMESTAMP '{cut}'", "NULL", "TRUE")
        return df.selectExpr(f"inline(CASE WHEN {changed} THEN array({one}, {two}) ELSE array({one}) END)")

    @cached_property
    def dim_server(self) -> DataFrame:
        servers = self.customer.selectExpr(
            "c_custkey AS id", "CAST(c_nationkey AS BIGINT) AS app_id", "'svr' || c_custkey AS hostname",
            "CAST(c_custkey % 16 + 1 AS INT) AS cpu_cores", "CAST(floor(c_acctbal) AS INT) AS memory", "c_mktsegment")
        first = "CASE WHEN c_mktsegment = 'FURNITURE' THEN TIMESTAMP '2024-01-05' ELSE TIMESTAMP '2023-12-01' END"
        return self._versioned(servers, schemas.ATTRIBUTES["server"].names, "id", first, "2024-01-15", "memory >= 5000",
                               {"cpu_cores": "cpu_cores * 2"})

    @cached_property
    def dim_app(self) -> DataFrame:
        apps = self.nation.selectExpr(
            "CAST(n_nationkey AS BIGINT) AS id", "n_name AS name", "'app of region ' || n_regionkey AS description",
            "'1.' || n_regionkey AS version", "n_regionkey")
        return self._versioned(apps, schemas.ATTRIBUTES["app"].names, "id", "TIMESTAMP '2023-12-01'", "2024-01-10",
                               "n_regionkey >= 3", {"version": "'2.' || n_regionkey"})

    @cached_property
    def dim_metric_index(self) -> DataFrame:
        return self._versioned(self.metric_index, schemas.ATTRIBUTES["metric_index"].names, "id", "TIMESTAMP '2023-12-01'",
                               "2024-01-20", "name = 'error'", {"description": "'new value of ' || name"})

    @cached_property
    def dim_metric_threshold(self) -> DataFrame:
        dwid = "server_id * 4294967296 + CAST(conv(substring(md5(metric_name), 1, 8), 16, 10) AS BIGINT)"
        return self._versioned(
            self.metric_threshold, schemas.ATTRIBUTES["metric_threshold"].names, dwid, "TIMESTAMP '2023-12-01'", "2024-01-12",
            "peak > 100", {"amber_threshold": "amber_threshold + 5", "red_threshold": "red_threshold + 5"})

    @cached_property
    def dim_hour(self) -> DataFrame:
        bounds = self.events.agg(F.date_trunc("day", F.min("ts")).alias("first"), F.max("ts").alias("last"))
        return hours_between(bounds)

    @property
    def dims(self) -> dict[str, DataFrame]:
        return {"app": self.dim_app, "server": self.dim_server, "metric_index": self.dim_metric_index,
                "metric_threshold": self.dim_metric_threshold, "hour": self.dim_hour}


# the same views for the oracle, in dependency order
VIEWS = {
    "metric": """
        SELECT event_id AS id, event_type AS name, 'svr' || user_id AS hostname,
               CAST(ROUND(value) AS BIGINT) AS value, ts AS "timestamp",
               strftime(ts, '%Y-%m-%d') AS creation_date, user_id
        FROM events""",
    "alert": """
        SELECT event_id AS id, 'alert type ' || (user_id % 3) AS message, 'svr' || user_id AS hostname,
               CASE WHEN event_type = 'error' THEN 'OPEN' ELSE 'CLOSED' END AS status,
               date_trunc('day', ts) AS "timestamp", ts AS created_time, user_id
        FROM events WHERE event_type IN ('error', 'signup')""",
    "alert_index": """
        SELECT DISTINCT user_id % 3 AS id, 'alert type ' || (user_id % 3) AS name,
               CAST(user_id % 3 AS INTEGER) AS severity
        FROM events""",
    "app": """
        SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, 'app of region ' || n_regionkey AS description,
               '1.' || n_regionkey AS version, TIMESTAMP '1995-01-01' AS creation_time,
               TIMESTAMP '1995-01-01' AS update_time, n_regionkey AS region
        FROM nation""",
    "server": """
        SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS app_id, 'svr' || c_custkey AS hostname,
               CAST(c_custkey % 16 + 1 AS INTEGER) AS cpu_cores, CAST(FLOOR(c_acctbal) AS INTEGER) AS memory,
               TIMESTAMP '1995-01-01' AS creation_time,
               CAST(DATE '1995-01-01' + CAST(c_custkey % 2400 AS INTEGER) AS TIMESTAMP) AS update_time,
               c_mktsegment AS segment
        FROM customer""",
    "metric_index": """
        SELECT DISTINCT CAST('0x' || substr(md5(event_type), 1, 8) AS BIGINT) AS id, event_type AS name,
               'value of ' || event_type AS description, substr(event_type, 1, 1) AS category,
               TIMESTAMP '1995-01-01' AS creation_time, TIMESTAMP '1995-01-01' AS update_time
        FROM events""",
    "metric_threshold": """
        SELECT user_id AS server_id, event_type AS metric_name, CAST(40 + user_id % 10 AS INTEGER) AS amber_threshold,
               CAST(55 + user_id % 10 AS INTEGER) AS red_threshold, TIMESTAMP '1995-01-01' AS creation_time,
               TIMESTAMP '1995-01-01' AS update_time, MAX(value) AS peak
        FROM events GROUP BY user_id, event_type""",
    "changes": """
        SELECT o_custkey AS id, o_orderstatus AS status, o_orderpriority AS priority, o_orderdate AS update_time,
               o_orderkey AS tie, strftime(o_orderdate, '%Y-%m-%d') AS update_date
        FROM orders""",
    "server_changes": """
        SELECT o_custkey AS id, o_orderkey % 25 AS app_id, 'svr' || o_custkey AS hostname,
               CAST(o_orderkey % 64 + 1 AS INTEGER) AS cpu_cores, CAST(FLOOR(o_totalprice) AS INTEGER) AS memory,
               TIMESTAMP '1995-01-01' AS creation_time, o_orderdate AS update_time, o_orderkey AS tie
        FROM orders""",
    "dim_server": """
        SELECT id * 2 + 1 AS dwid, id, app_id, hostname, cpu_cores, memory,
               CASE WHEN segment = 'FURNITURE' THEN TIMESTAMP '2024-01-05' ELSE TIMESTAMP '2023-12-01' END AS valid_from,
               CASE WHEN memory >= 5000 THEN TIMESTAMP '2024-01-15' END AS valid_to, memory < 5000 AS eff_flag
        FROM server
        UNION ALL
        SELECT id * 2 + 2, id, app_id, hostname, cpu_cores * 2, memory, TIMESTAMP '2024-01-15', NULL, TRUE
        FROM server WHERE memory >= 5000""",
    "dim_app": """
        SELECT id * 2 + 1 AS dwid, id, name, description, version, TIMESTAMP '2023-12-01' AS valid_from,
               CASE WHEN region >= 3 THEN TIMESTAMP '2024-01-10' END AS valid_to, region < 3 AS eff_flag
        FROM app
        UNION ALL
        SELECT id * 2 + 2, id, name, description, '2.' || region, TIMESTAMP '2024-01-10', NULL, TRUE
        FROM app WHERE region >= 3""",
    "dim_metric_index": """
        SELECT id * 2 + 1 AS dwid, id, name, description, category, TIMESTAMP '2023-12-01' AS valid_from,
               CASE WHEN name = 'error' THEN TIMESTAMP '2024-01-20' END AS valid_to, name <> 'error' AS eff_flag
        FROM metric_index
        UNION ALL
        SELECT id * 2 + 2, id, name, 'new value of ' || name, category, TIMESTAMP '2024-01-20', NULL, TRUE
        FROM metric_index WHERE name = 'error'""",
    "dim_metric_threshold": """
        SELECT (server_id * 4294967296 + CAST('0x' || substr(md5(metric_name), 1, 8) AS BIGINT)) * 2 + 1 AS dwid,
               server_id, metric_name, amber_threshold, red_threshold, TIMESTAMP '2023-12-01' AS valid_from,
               CASE WHEN peak > 100 THEN TIMESTAMP '2024-01-12' END AS valid_to, peak <= 100 AS eff_flag
        FROM metric_threshold
        UNION ALL
        SELECT (server_id * 4294967296 + CAST('0x' || substr(md5(metric_name), 1, 8) AS BIGINT)) * 2 + 2,
               server_id, metric_name, amber_threshold + 5, red_threshold + 5, TIMESTAMP '2024-01-12', NULL, TRUE
        FROM metric_threshold WHERE peak > 100""",
    "dim_hour": """
        SELECT CAST(strftime(h, '%Y%m%d%H') AS BIGINT) AS dwid, strftime(h, '%Y-%m-%d') AS db_date, h AS db_hour,
               CAST(year(h) AS INTEGER) AS "year", CAST(month(h) AS INTEGER) AS "month",
               CAST(day(h) AS INTEGER) AS "day", CAST(hour(h) AS INTEGER) AS "hour",
               CAST(quarter(h) AS INTEGER) AS "quarter", CAST(strftime(h, '%W') AS INTEGER) AS week,
               strftime(h, '%A') AS day_name, strftime(h, '%B') AS month_name, isodow(h) >= 6 AS weekend_flag
        FROM (SELECT unnest(generate_series(date_trunc('day', MIN(ts)), MAX(ts), INTERVAL 1 HOUR)) AS h FROM events)""",
}
NEEDS = {
    "dim_server": ["server"],
    "dim_app": ["app"],
    "dim_metric_index": ["metric_index"],
    "dim_metric_threshold": ["metric_threshold"],
}


def with_views(names: str, body: str) -> str:
    """A statement that defines the named views (and what they need) before its body."""
    wanted: list[str] = []
    for name in names.split():
        for one in (*NEEDS.get(name, []), name):
            if one not in wanted:
                wanted.append(one)
    views = ", ".join(f"{n} AS ({VIEWS[n]})" for n in wanted)
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {views}, {body[5:]}"
    return f"WITH {views} {body}"


def stamp(expression: str) -> str:
    """A timestamp as the text that query results carry."""
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"
