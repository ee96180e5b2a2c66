"""One declared schema per warehouse table and per stream message."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, INT, STR, TS, BOOL = T.LongType(), T.IntegerType(), T.StringType(), T.TimestampType(), T.BooleanType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def extend(base: T.StructType, **fields: T.DataType) -> T.StructType:
    return T.StructType(list(base.fields) + list(struct(**fields).fields))


def as_text(base: T.StructType) -> T.StructType:
    """The landing form of a schema: dates and timestamps held as strings."""
    return T.StructType([
        T.StructField(f.name, STR if isinstance(f.dataType, (T.TimestampType, T.DateType)) else f.dataType)
        for f in base.fields
    ])


# attributes that describe a business entity, without its audit times
ATTRIBUTES = {
    "app": struct(id=LONG, name=STR, description=STR, version=STR),
    "server": struct(id=LONG, app_id=LONG, hostname=STR, cpu_cores=INT, memory=INT),
    "metric_index": struct(id=LONG, name=STR, description=STR, category=STR),
    "metric_threshold": struct(server_id=LONG, metric_name=STR, amber_threshold=INT, red_threshold=INT),
}
KEYS = {
    "app": ["id"],
    "server": ["id"],
    "metric_index": ["id"],
    "metric_threshold": ["server_id", "metric_name"],
}
MASTER_TABLES = tuple(ATTRIBUTES)

MASTER = {name: extend(s, creation_time=TS, update_time=TS) for name, s in ATTRIBUTES.items()}
ALERT_INDEX = struct(id=LONG, name=STR, severity=INT, creation_time=TS, update_time=TS)
METRIC = struct(id=LONG, name=STR, hostname=STR, value=LONG, timestamp=TS)
ALERT = struct(id=LONG, message=STR, hostname=STR, status=STR, timestamp=TS, created_time=TS)

# stream messages carry epoch seconds
METRIC_MESSAGE = struct(id=LONG, name=STR, hostname=STR, value=LONG, timestamp=LONG)
ALERT_MESSAGE = struct(id=LONG, message=STR, hostname=STR, status=STR, timestamp=LONG)
TRUNK = struct(key=STR, value=STR)
SERVER_STATE = struct(server_id=LONG, timestamp=LONG, src_type=STR, severity=INT)

# the serving document of a server; times are epoch milliseconds
THRESHOLD_ENTRY = struct(redThreshold=INT, amberThreshold=INT, creationTime=LONG, updateTime=LONG)
SERVER_DOCUMENT = struct(
    id=LONG, hostname=STR, cpuCores=INT, memory=INT, appId=LONG,
    metricThresholds=T.MapType(STR, THRESHOLD_ENTRY), creationTime=LONG, updateTime=LONG,
)
DATA_POINT = struct(metric=STR, value=STR, timestamp=LONG, tags=T.MapType(STR, STR))


def dimension(attributes: T.StructType) -> T.StructType:
    return extend(
        T.StructType([T.StructField("dwid", LONG), *attributes.fields]),
        valid_from=TS, valid_to=TS, eff_flag=BOOL,
    )


DIM = {name: dimension(s) for name, s in ATTRIBUTES.items()}
DIM_HOUR = struct(
    dwid=LONG, db_date=STR, db_hour=TS, year=INT, month=INT, day=INT, hour=INT,
    quarter=INT, week=INT, day_name=STR, month_name=STR, weekend_flag=BOOL,
)
FACT_METRIC = struct(
    id=LONG, app_dwid=LONG, server_dwid=LONG, metric_index_dwid=LONG, hour_dwid=LONG,
    timestamp=TS, value=LONG, creation_date=STR,
)
SUM_METRIC_AVG = struct(
    app_dwid=LONG, server_dwid=LONG, metric_index_dwid=LONG, metric_threshold_dwid=LONG,
    hour_dwid=LONG, avg_value=INT, rag=STR, creation_date=STR,
)
WIDE_METRIC_AVG = struct(
    app_dwid=LONG, app_name=STR, app_description=STR, app_version=STR,
    server_dwid=LONG, server_hostname=STR, server_cpu_cores=INT, server_memory=INT,
    metric_index_dwid=LONG, metric_name=STR, metric_description=STR, metric_category=STR,
    metric_threshold_dwid=LONG, amber_threshold=INT, red_threshold=INT,
    hour_dwid=LONG, db_date=STR, db_hour=TS, year=INT, month=INT, day=INT, hour=INT,
    quarter=INT, week=INT, day_name=STR, month_name=STR, weekend_flag=BOOL,
    avg_value=LONG, rag=STR, creation_date=STR,
)

# layer -> table -> (schema, partition columns)
LAYERS: dict[str, dict[str, tuple[T.StructType, list[str]]]] = {
    "tmp": {
        **{name: (as_text(s), []) for name, s in MASTER.items()},
        "metric": (as_text(METRIC), []),
        "dim_hour": (as_text(DIM_HOUR), []),
    },
    "src": {
        **{name: (extend(s, imported_time=TS, update_date=STR), ["update_date"]) for name, s in MASTER.items()},
        "metric": (extend(METRIC, imported_time=TS, creation_date=STR), ["creation_date"]),
    },
    "dwh": {
        **{name: (extend(s, imported_time=TS), []) for name, s in MASTER.items()},
        "metric": (extend(METRIC, imported_time=TS, creation_date=STR), ["creation_date"]),
    },
    "dmt": {
        **{f"dim_{name}": (s, []) for name, s in DIM.items()},
        "dim_hour": (DIM_HOUR, []),
        "fact_metric": (FACT_METRIC, ["creation_date"]),
        "sum_metric_avg": (SUM_METRIC_AVG, ["creation_date"]),
        "wide_metric_avg": (WIDE_METRIC_AVG, ["creation_date"]),
    },
}
