"""Landing to src typing, and src to dwh merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry import schemas
from beaconry.functions.times import date_string, parse_timestamp
from beaconry.operators.merge import merge_latest
from beaconry.sources.extract import date_range

AUDIT = ("creation_time", "update_time", "imported_time")


def as_now(now: str | Column) -> Column:
    """The import time. Given by the caller, so a rerun of a day writes the same rows."""
    return F.to_timestamp(F.lit(now)) if isinstance(now, str) else now


def drop_cols(df: DataFrame, *names: str) -> DataFrame:
    """All columns except some; names that are not there are ignored."""
    return df.drop(*names)


def build_src_master(landed: DataFrame, table: str, now: str | Column) -> DataFrame:
    """Typed rows of a master table with import time and the date of their update."""
    schema = schemas.MASTER[table]
    typed = landed.select(*[
        parse_timestamp(f.name).alias(f.name) if f.dataType == schemas.TS else F.col(f.name).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])
    return typed.withColumn("imported_time", as_now(now)).withColumn("update_date", date_string("update_time"))


def build_src_metric(landed: DataFrame, now: str | Column) -> DataFrame:
    """Typed metric rows with import time and the date of their event."""
    return landed.select(
        F.col("id").cast("long").alias("id"),
        "name",
        "hostname",
        F.col("value").cast("long").alias("value"),
        parse_timestamp("timestamp").alias("timestamp"),
        as_now(now).alias("imported_time"),
    ).withColumn("creation_date", date_string("timestamp"))


def build_dwh_metric(src_metric: DataFrame, start: str, end: str) -> DataFrame:
    """The metric rows of a range of days."""
    wanted = schemas.LAYERS["dwh"]["metric"][0]
    return date_range(src_metric, "creation_date", start, end).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted.fields]
    )


def master_delta(src: DataFrame, start: str, end: str) -> DataFrame:
    """The increments of a range of days, as they are merged into the current rows."""
    return drop_cols(date_range(src, "update_date", start, end), "update_date")


def build_dwh_master(full: DataFrame, src: DataFrame, table: str, start: str, end: str, limit: int | None = None) -> DataFrame:
    """The current row of each key after the increments of a range of days."""
    return merge_latest(full, master_delta(src, start, end), schemas.KEYS[table], full_is_unique=True, limit=limit)
