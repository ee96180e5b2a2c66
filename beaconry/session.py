"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # date partitions are strings throughout the warehouse
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


# settings that only a new session can take
STATIC_SETTINGS = {
    "spark.ui.enabled": "false",
    # plans are built from many small column calls; recording a call site for each doubles that time
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "beaconry", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**STATIC_SETTINGS, **RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator here relies on to an existing session.

    The number of shuffle partitions belongs to the cluster and is left alone, except
    that a local session still on the default of 200 gets one per core.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    if is_local(spark) and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="beaconry-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


# the open scratch scope; each thread has its own, and hands it to threads it starts by copying its context
_SCOPE: ContextVar[str | None] = ContextVar("beaconry_scope", default=None)


def _scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/beaconry/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """An unused path in this application's part of the shared folder, within the open scratch scope if there is one."""
    return f"{_SCOPE.get() or _scratch(spark)}/{label}-{uuid.uuid4().hex}"


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession, name: str | None = None) -> Iterator[None]:
    """Remove the intermediate tables made within, whose results must have been written elsewhere by then.

    Only this thread's tables, and those of threads started in a copy of its context, belong to the scope; what other
    threads write meanwhile stays. With a ``name`` the scope belongs to a run rather than a process: what an earlier
    process left of it is removed first.
    """
    folder = f"{shared_folder(spark).rstrip('/')}/beaconry/{name}" if name else fresh_path(spark, "scope")
    if name:
        _remove(spark, folder)
    token = _SCOPE.set(folder)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        _remove(spark, folder)


def clear_scratch(spark: SparkSession) -> None:
    """Remove everything this application has put under its part of the shared folder."""
    _remove(spark, _scratch(spark))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a result that several later steps read, and return the written table.

    Unlike a cache it survives the loss of executors, and unlike a checkpointed RDD it
    keeps column pruning, filter pushdown and file statistics.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
