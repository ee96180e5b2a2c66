"""What a stream carries from batch to batch as tables: no more than its watermark asks for, and nothing held in memory.

Spark's own state keeps an entry per key in the executors' memory until the watermark of the next batch has passed it, so
a backlog of any length is held whole. Here a batch is grouped like a table, and only what a later row can still meet is
written down. A batch that runs again reads what the batch before it left, and leaves the same.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from beaconry.sources.buckets import MARKED, finished
from beaconry.sources.files import delete, listed, read_text, write_text
from beaconry.streaming.sinks import BATCH

# records of earlier batches that are kept, for batches that run again
KEPT_TIMES = 100


def newest_times(spark: SparkSession, folder: str, batch_id: int) -> dict[str, int]:
    """The newest event time of each source in all batches before this one."""
    before = [int(n) for n in listed(spark, folder) if n.isdigit() and int(n) < batch_id]
    return json.loads(read_text(spark, f"{folder}/{max(before)}")) if before else {}


def record_times(spark: SparkSession, folder: str, batch_id: int, before: dict[str, int], newest: dict[str, int | None]) -> dict[str, int]:
    """Note the newest event times as this batch leaves them, and return them."""
    times = {m: [t for t in (before.get(m), newest.get(m)) if t is not None] for m in {**before, **newest}}
    after = {m: max(t) for m, t in times.items() if t}
    write_text(spark, f"{folder}/{batch_id}", json.dumps(after))
    for n, path in listed(spark, folder).items():
        if n.isdigit() and int(n) <= batch_id - KEPT_TIMES:
            delete(spark, path)
    return after


def read_carried(spark: SparkSession, folder: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """What the batches before this one left."""
    before = {n: p for n, p in finished(spark, folder, BATCH).items() if n < batch_id}
    return spark.read.schema(schema).parquet(before[max(before)]) if before else spark.createDataFrame([], schema)


def write_carried(rows: DataFrame, folder: str, batch_id: int) -> None:
    """Leave rows to the next batch; those of the batch before stay, in case this one runs again."""
    spark = rows.sparkSession
    rows.write.mode("overwrite").option(MARKED, "true").parquet(f"{folder}/{BATCH}={batch_id}")
    for n, path in finished(spark, folder, BATCH).items():
        if n < batch_id - 1:
            delete(spark, path)
