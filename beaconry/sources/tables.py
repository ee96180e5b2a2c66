"""Reading and writing warehouse tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconry import schemas
from beaconry.session import materialize
from beaconry.sources.extract import date_range

# ---------------------------------------------------------------- landing and scans


def as_text(df: DataFrame) -> DataFrame:
    """Dates and timestamps as strings, all other columns as they are."""
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.select(*[
        F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, times) else F.col(f.name)
        for f in df.schema.fields
    ])


def land_extract(df: DataFrame, path: str) -> DataFrame:
    """Overwrite the landing table with this extract and return it as written."""
    landed = as_text(df)
    landed.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(landed.schema).parquet(path)


def read_hour_csv(spark: SparkSession, path: str) -> DataFrame:
    """The comma-separated hour calendar, with its declared schema."""
    return spark.read.schema(schemas.DIM_HOUR).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path)


def read_partition_range(spark: SparkSession, path: str, schema: T.StructType, col: str, start: str, end: str,
                         closed: str = "left") -> DataFrame:
    """Rows of a range of partitions; the declared schema keeps the partition column a string."""
    return date_range(spark.read.schema(schema).parquet(path), col, start, end, closed)


# ---------------------------------------------------------------- partitioned and replaced tables


def overwrite_partitions(df: DataFrame, path: str, cols: Sequence[str], rebalance: bool = False) -> None:
    """Replace exactly the partitions present in ``df``; all others stay.

    ``rebalance`` shuffles to well-sized files first, splitting large partitions. It pays
    off when a write spans many dates and would leave every task with a file per date.
    """
    if rebalance:
        df = df.hint("rebalance", *cols)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)


def _versions(spark: SparkSession, path: str) -> tuple[object, object, list[int]]:
    """Finished versions of a replaced table, oldest first; a version counts once its job has committed."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return fs, jvm, []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    found = [int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit()]
    done = [n for n in found if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/v={n}/_SUCCESS"))]
    return fs, jvm, sorted(done)


def replace_table(df: DataFrame, path: str, keep: int = 2) -> DataFrame:
    """Replace a whole table by a result that may have been computed from it.

    The result goes to a new version folder while readers and the running query still
    use the current one; it becomes current when Spark's commit marker appears. The last
    ``keep`` versions are retained for readers already under way.
    """
    spark = df.sparkSession
    fs, jvm, done = _versions(spark, path)
    target = f"{path}/v={(done[-1] if done else 0) + 1}"
    # the marker must be written whatever the cluster's default is
    df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(target)
    for old in done[: max(len(done) + 1 - keep, 0)]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/v={old}"), True)
    return spark.read.schema(df.schema).parquet(target)


def current_version(spark: SparkSession, path: str) -> int:
    """The number of the current version of a replaced table, 0 before the first."""
    _, _, done = _versions(spark, path)
    return done[-1] if done else 0


def read_table(spark: SparkSession, path: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """The current version of a replaced table, or no rows before the first write; or a version that is still kept."""
    version = current_version(spark, path) if version is None else version
    if not version:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/v={version}")


def compact_partitions(spark: SparkSession, path: str, schema: T.StructType, col: str, start: str, end: str) -> None:
    """Rewrite old partitions into fewer, well-sized files."""
    staged = materialize(read_partition_range(spark, path, schema, col, start, end), "compact")
    overwrite_partitions(staged, path, [col], rebalance=True)


# ---------------------------------------------------------------- catalog layers


def layer_tables(layer: str, prefix: str = "") -> list[str]:
    """The tables of a layer; its database is named like the layer, after an optional prefix."""
    return [f"{prefix}{layer}.{name}" for name in schemas.LAYERS[layer]]


def create_tables(spark: SparkSession, layer: str, location: str | None = None, prefix: str = "") -> list[str]:
    """Create the database of a layer and all its declared tables."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer}{place}")
    for name, (schema, parts) in schemas.LAYERS[layer].items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = f" PARTITIONED BY ({', '.join(parts)})" if parts else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}{layer}.{name} ({columns}) USING parquet{by}")
    return layer_tables(layer, prefix)


def truncate_tables(spark: SparkSession, layer: str, prefix: str = "") -> None:
    for table in layer_tables(layer, prefix):
        spark.sql(f"TRUNCATE TABLE {table}")


def drop_tables(spark: SparkSession, layer: str, prefix: str = "") -> None:
    for table in layer_tables(layer, prefix):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"DROP DATABASE IF EXISTS {prefix}{layer}")


def insert_table(df: DataFrame, table: str) -> None:
    """Overwrite a catalog table, or only the partitions present in ``df`` when it is partitioned."""
    spark = df.sparkSession
    df.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
