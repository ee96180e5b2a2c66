"""The hour calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry import schemas
from beaconry.functions.times import calendar_parts, date_string


def hour_rows(hours: DataFrame, hour: Column | str = "db_hour") -> DataFrame:
    """Calendar rows for a frame of distinct hour starts."""
    hour = F.col(hour) if isinstance(hour, str) else hour
    parts = calendar_parts(hour)
    return hours.select(
        F.date_format(hour, "yyyyMMddHH").cast("long").alias("dwid"),
        date_string(hour).alias("db_date"),
        hour.alias("db_hour"),
        *[c.alias(name) for name, c in parts.items()],
    ).select(*schemas.DIM_HOUR.names)


def build_dim_hour(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per hour from ``start`` to ``end``, both included."""
    bounds = spark.range(1).select(F.to_timestamp(F.lit(start)).alias("first"), F.to_timestamp(F.lit(end)).alias("last"))
    return hours_between(bounds)


def hours_between(bounds: DataFrame) -> DataFrame:
    """Calendar rows covering the ``first`` to ``last`` times of a one-row frame."""
    hours = bounds.select(
        F.explode(F.sequence(F.date_trunc("hour", "first"), F.col("last"), F.expr("INTERVAL 1 HOUR"))).alias("db_hour")
    )
    return hour_rows(hours)
