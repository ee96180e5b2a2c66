"""Keyed stream sinks on plain Parquet: append each micro-batch, fold into buckets, keep the last row per key on read.

A sink's folder holds ``delta/batch_id=N`` for every batch not yet folded, and what was folded as a table in buckets, see
``sources.buckets``: a fold rewrites the buckets its batches touch and no other. Sinks without keys keep ``rows/fold=S``
instead, where every fold adds rows, and ``rows/whole=S``, which stands for all before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from beaconry.operators.merge import latest_per_key
from beaconry.operators.skew import part_of, sized_join, task_parts
from beaconry.session import materialize
from beaconry.sources.buckets import (
    BUCKET,
    BUCKETS,
    FOLD,
    MARKED,
    bucket_count,
    bucket_of,
    current_folders,
    drop_superseded,
    finished,
    next_fold,
    read_folders,
    write_fold,
)
from beaconry.sources.files import delete, exists, listed, make_folder

BATCH, WHOLE = "batch_id", "whole"
# fixed values: key and columns of each sink
METRIC_SINK = (["id"], ["id", "name", "hostname", "timestamp", "value"])
ALERT_SINK = (["id"], ["id", "hostname", "message", "status", "timestamp"])
STATE_SINK_COLUMNS = ["server_id", "timestamp", "src_type", "severity"]
# batches after which a sink folds its folders
COMPACT_EVERY = 100
# rows that one task sorts by key, where a key has few of them
ROWS_PER_TASK = 500_000

Sink = Callable[[DataFrame, int], None]


def state_keys(shared_key: bool = False) -> list[str]:
    """Key of a server state. With ``shared_key`` metric and alert states overwrite each other."""
    return ["server_id", "timestamp"] if shared_key else ["server_id", "timestamp", "src_type"]


def upsert_sink(path: str, columns: Sequence[str], keys: Sequence[str] = (), every: int = COMPACT_EVERY,
                buckets: int = BUCKETS, costly: bool = False) -> Sink:
    """Write each micro-batch to its own folder, and fold the folders into the buckets after ``every`` batches.

    The cost of a batch is that of its rows, and the cost of a fold that of the buckets its batches touch. A batch that
    is run again after a failure replaces its own folder, so nothing is written twice. An empty batch leaves nothing.
    Folding happens here, between two batches of the one query that owns the sink, so no batch is being written meanwhile
    and readers list ``every`` folders at most. Without keys every row is kept. A ``costly`` batch is computed once: it is
    written without a look for its first row, and its folder removed if there was none.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*columns)
        spark = rows.sparkSession
        folder = f"{path}/delta/{BATCH}={batch_id}"
        again = exists(spark, folder)
        if costly or again or not rows.isEmpty():
            rows.write.mode("overwrite").option(MARKED, "true").parquet(folder)
        if costly and not again and spark.read.schema(rows.schema).parquet(folder).isEmpty():
            delete(spark, folder)
        if every and (batch_id + 1) % every == 0:
            fold_upserts(spark, path, rows.schema, keys, buckets)

    return write


def start_query(df: DataFrame, sink: Sink, checkpoint: str, name: str | None = None, available_now: bool = False,
                pool: str | None = None, mode: str = "update") -> StreamingQuery:
    """Start a query with its own checkpoint and scheduler pool."""
    context = df.sparkSession.sparkContext
    before = context.getLocalProperty("spark.scheduler.pool")
    context.setLocalProperty("spark.scheduler.pool", pool or name)
    try:
        writer = df.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
        if name:
            writer = writer.queryName(name)
        if available_now:
            writer = writer.trigger(availableNow=True)
        return writer.start()
    finally:
        # the query has taken the pool; later jobs of this thread have not
        context.setLocalProperty("spark.scheduler.pool", before)


def start_update_query(df: DataFrame, sink: Sink, checkpoint: str, name: str | None = None,
                       available_now: bool = False, pool: str | None = None) -> StreamingQuery:
    """Start a query in update mode: a row is given out whenever it changes."""
    return start_query(df, sink, checkpoint, name, available_now, pool)


def _kept_rows(spark: SparkSession, root: str) -> list[str]:
    """The folders that make up a sink without keys."""
    whole = finished(spark, root, WHOLE)
    since = max(whole, default=-1)
    return [*([whole[since]] if whole else []), *[p for n, p in finished(spark, root, FOLD).items() if n > since]]


def _stored(schema: T.StructType, *more: str) -> T.StructType:
    kinds = {BATCH: T.LongType(), BUCKET: T.IntegerType()}
    return T.StructType([*schema.fields, *[T.StructField(m, kinds[m]) for m in more]])


def _base(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], only: set[int] | None = None) -> DataFrame:
    """Folded rows with their batch and bucket, of all buckets or of some, whose folders alone are opened."""
    stored = _stored(schema, BATCH, BUCKET)
    count = bucket_count(spark, path, 0)
    root = f"{path}/base-{count}"
    folders = [p for b, p in sorted(current_folders(spark, root).items()) if only is None or b in only] if count else []
    parts = [read_folders(spark, root, _stored(schema, BATCH), folders)] if folders else []
    kept = _kept_rows(spark, f"{path}/rows")
    if kept:
        rows = spark.read.schema(_stored(schema, BATCH)).parquet(*kept)
        rows = rows.withColumn(BUCKET, bucket_of(keys, count or BUCKETS) if keys else F.lit(0))
        parts.append(rows if only is None else rows.filter(F.col(BUCKET).isin(*only)))
    if not parts:
        return spark.createDataFrame([], stored)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _pending(spark: SparkSession, path: str, schema: T.StructType, batches: dict[int, str]) -> DataFrame:
    reader = spark.read.schema(_stored(schema, BATCH)).option("basePath", f"{path}/delta")
    return reader.parquet(*batches.values())


def _latest(rows: DataFrame, keys: Sequence[str], few: bool = False) -> DataFrame:
    if few:
        # not sorted where they are, which would leave nearly all of them
        rows = rows.repartition(task_parts(rows.sparkSession, rows.count(), ROWS_PER_TASK), *keys)
    # within a batch the last row is undefined, so settle ties by value
    rest = [c for c in rows.columns if c not in (*keys, BATCH, BUCKET)]
    return latest_per_key(rows, keys, [F.desc(BATCH), *[F.desc(c) for c in rest]])


def _folded(spark: SparkSession, path: str) -> bool:
    """Whether a sink has folded any batch."""
    return any(current_folders(spark, root) for root in _roots(spark, path)) or bool(_kept_rows(spark, f"{path}/rows"))


def _merged(base: DataFrame, pending: DataFrame, keys: Sequence[str], again: list[int], follows: bool,
            few: bool = False) -> DataFrame:
    """The current row of each key of folded and pending rows.

    Usually all pending batches follow the folded ones, so their rows replace those of their keys; the folded rows are
    then not shuffled while the pending keys are few enough to broadcast. If one that was folded ran again, it counts as
    it is now, and batches are compared row by row.
    """
    columns = pending.columns
    if not follows:
        base = base.filter(~F.col(BATCH).isin(again)).select(*columns)
        return _latest(base.unionByName(pending), keys, few)
    newest = materialize(_latest(pending, keys, few), "sink-newest")
    replaced = part_of(newest.select(*keys), newest)
    kept = sized_join(base.select(*columns), replaced, keys, "left_anti", null_safe=True)
    return kept.unionByName(newest)


def _follows(spark: SparkSession, path: str, batches: dict[int, str]) -> bool:
    """Whether all pending batches are younger than every folded one; a fold's marker names the youngest it holds."""
    names = [n for root in [f"{path}/rows", *_roots(spark, path)] for n in listed(spark, root, "upto=")]
    return min(batches) > max((int(n) for n in names if n.isdigit()), default=-1)


def _roots(spark: SparkSession, path: str) -> list[str]:
    return list(listed(spark, path, "base-").values())


def read_upserts(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str] = (),
                 wanted: DataFrame | None = None, few: bool = False) -> DataFrame:
    """The current row of each key, or all rows without keys.

    With ``wanted``, a table of keys, only these rows are returned and only the buckets they live in are opened. ``few`` says
    that a batch has few rows of a key: they are dealt into parts that follow the rows, and sorted there only.
    """
    batches = finished(spark, f"{path}/delta", BATCH)
    only = None
    if wanted is not None:
        # a bucket depends on the type of its key
        wanted = materialize(wanted.select(*[F.col(k).cast(schema[k].dataType) for k in keys]).distinct(), "sink-wanted")
        count = bucket_count(spark, path, BUCKETS)
        only = {r[0] for r in wanted.select(bucket_of(keys, count)).distinct().collect()}
    base = _base(spark, path, schema, keys, only)
    if batches:
        pending = _pending(spark, path, schema, batches)
        if wanted is not None:
            pending = sized_join(pending, wanted, keys, "left_semi", null_safe=True)
    if wanted is not None:
        base = sized_join(base, wanted, keys, "left_semi", null_safe=True)
    if not keys:
        if not batches:
            return base.drop(BATCH, BUCKET)
        return base.filter(~F.col(BATCH).isin(list(batches))).drop(BUCKET).unionByName(pending).drop(BATCH)
    if batches and not _folded(spark, path):
        # written, as a fold may remove the batches before the rows are asked for
        return materialize(_latest(pending, keys, few), "sink-newest").drop(BATCH)
    unranked = bool(_kept_rows(spark, f"{path}/rows"))
    if not batches:
        return (_latest(base.drop(BUCKET), keys, few) if unranked else base).drop(BATCH, BUCKET)
    follows = not unranked and _follows(spark, path, batches)
    return _merged(base, pending, keys, list(batches), follows, few).drop(BATCH)


def fold_upserts(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str] = (),
                 buckets: int = BUCKETS) -> list[int]:
    """Fold the finished batches into their buckets, and say which buckets that rewrote.

    The fold is committed before its batches are removed; a batch that the stream runs again later only repeats rows the
    buckets already have. Buckets no batch touches, and folders of unfinished batches, stay as they are.
    """
    batches = finished(spark, f"{path}/delta", BATCH)
    if not batches:
        return []
    pending = _pending(spark, path, schema, batches)
    count = bucket_count(spark, path, buckets)
    root = f"{path}/base-{count}" if keys else f"{path}/rows"
    sequence = next_fold(spark, root, FOLD, WHOLE)
    touched: list[int] = []
    if keys:
        own = pending.withColumn(BUCKET, bucket_of(keys, count))
        touched = sorted(r[0] for r in own.select(BUCKET).distinct().collect())
        base = _base(spark, path, schema, keys, set(touched))
        merged = _merged(base, own, keys, list(batches), _follows(spark, path, batches))
        write_fold(merged, root, sequence)
    else:
        name, older = FOLD, []
        if not _follows(spark, path, batches):
            # a batch ran again after it was folded: what the folds hold of it is replaced
            older = _kept_rows(spark, root)
            pending = _base(spark, path, schema, keys).filter(~F.col(BATCH).isin(list(batches))).drop(BUCKET).unionByName(pending)
            name = WHOLE
        pending.hint("rebalance").write.option(MARKED, "true").parquet(f"{root}/{name}={sequence}")
        for folder in older:
            delete(spark, folder)
    _mark(spark, root, max(batches))
    for folder in batches.values():
        delete(spark, folder)
    if keys:
        drop_superseded(spark, root)
    return touched


def _mark(spark: SparkSession, root: str, batch: int) -> None:
    """Note the youngest batch folded so far; an older note may go only when the new one is there."""
    before = listed(spark, root, "upto=")
    make_folder(spark, f"{root}/upto={batch}")
    for name, folder in before.items():
        if name.isdigit() and int(name) < batch:
            delete(spark, folder)


def compact_upserts(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str] = (),
                    buckets: int = BUCKETS) -> DataFrame:
    """Fold now, whatever the number of batches, and return the table."""
    fold_upserts(spark, path, schema, keys, buckets)
    return read_upserts(spark, path, schema, keys)
