"""Registration of queries with their oracle statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconry.queries.adapters import Tables, with_views
from beaconry.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Timestamps as text with microseconds, so that both engines compare alike."""
    return df.select(*[
        F.date_format(f"`{f.name}`", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(f.name)
        if isinstance(f.dataType, T.TimestampType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def query(name: str, views: str = "", sql: str | None = None):
    """Register a query over the test tables, with the statement that checks it."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(build(Tables(tune(spark), folder)))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(views, sql) if views else sql.strip()
        return build

    return register
