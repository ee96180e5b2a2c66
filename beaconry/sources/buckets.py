"""Keyed tables in buckets: a merge reads and rewrites the buckets its rows touch, and no other.

A table's folder holds ``base-B/fold=S/bucket=K``, where B is the number of buckets and a key lives in bucket
``pmod(xxhash64(key), B)``. Every merge is a fold; the newest finished fold that has a bucket is that bucket's content.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconry.operators.merge import OC, latest_per_key, tagged_union
from beaconry.session import materialize
from beaconry.sources.files import delete, exists, listed

BUCKET, FOLD = "bucket", "fold"
# buckets of a new table; one that exists keeps its number
BUCKETS = 64
# folds a superseded bucket stays for readers already under way
KEPT_FOLDS = 1
MARKED = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


def finished(spark: SparkSession, path: str, name: str) -> dict[int, str]:
    """Numbered folders whose job has committed, oldest first; one still being written has no marker."""
    found = {int(n): p for n, p in listed(spark, path, f"{name}=").items() if n.isdigit()}
    return {n: found[n] for n in sorted(found) if exists(spark, f"{found[n]}/_SUCCESS")}


def bucket_count(spark: SparkSession, path: str, default: int) -> int:
    """The number of buckets a table was first written with."""
    return min((int(n) for n in listed(spark, path, "base-") if n.isdigit()), default=default)


def bucket_of(keys: Sequence[str], count: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int")


def next_fold(spark: SparkSession, root: str, *names: str) -> int:
    taken = [int(n) for name in (names or (FOLD,)) for n in listed(spark, root, f"{name}=") if n.isdigit()]
    return 1 + max(taken, default=0)


def current_folders(spark: SparkSession, root: str, upto: int | None = None) -> dict[int, str]:
    """The folder that holds each bucket's content, now or as of a fold that is still kept."""
    current: dict[int, str] = {}
    for fold, path in finished(spark, root, FOLD).items():
        if upto is None or fold <= upto:
            current |= {int(b): p for b, p in listed(spark, path, f"{BUCKET}=").items()}
    return current


def read_folders(spark: SparkSession, root: str, schema: T.StructType, folders: list[str]) -> DataFrame:
    """The rows of some buckets, with their bucket."""
    stored = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    if not folders:
        return spark.createDataFrame([], stored)
    return spark.read.schema(stored).option("basePath", root).parquet(*folders).select(*stored.names)


def write_fold(rows: DataFrame, root: str, fold: int) -> None:
    """Write whole buckets as a new fold, in well-sized files; they become current when the job commits."""
    # a new folder, not an overwrite: dynamic overwrites leave no commit marker
    rows.hint("rebalance", BUCKET).write.option(MARKED, "true").partitionBy(BUCKET).parquet(f"{root}/{FOLD}={fold}")


def drop_superseded(spark: SparkSession, root: str, keep: int = KEPT_FOLDS) -> None:
    """Remove buckets that more than ``keep`` younger folds have, and folders of folds that were never finished."""
    folds = finished(spark, root, FOLD)
    younger: dict[str, int] = {}
    for path in reversed(list(folds.values())):
        left = listed(spark, path, f"{BUCKET}=")
        for bucket, folder in list(left.items()):
            if younger.get(bucket, 0) > keep:
                delete(spark, folder)
                del left[bucket]
            else:
                younger[bucket] = younger.get(bucket, 0) + 1
        if not left:
            delete(spark, path)
    for n, path in listed(spark, root, f"{FOLD}=").items():
        if n.isdigit() and int(n) < max(folds, default=0) and int(n) not in folds:
            delete(spark, path)


def read_buckets(spark: SparkSession, path: str, schema: T.StructType, upto: int | None = None) -> DataFrame:
    """A keyed table as it is now, or as of a fold that is still kept; no rows before the first merge."""
    count = bucket_count(spark, path, 0)
    root = f"{path}/base-{count}"
    folders = current_folders(spark, root, upto) if count else {}
    return read_folders(spark, root, schema, [folders[b] for b in sorted(folders)]).drop(BUCKET)


def current_fold(spark: SparkSession, path: str) -> int:
    """The number of the newest fold, 0 before the first."""
    return max(finished(spark, f"{path}/base-{bucket_count(spark, path, 0)}", FOLD), default=0)


def merge_buckets(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], rows: DataFrame,
                  order_col: str = "update_time", ties: Sequence[Column] = (), buckets: int = BUCKETS,
                  keep: int = KEPT_FOLDS) -> list[int]:
    """Merge an increment into a keyed table by the rule of ``merge_latest``, and say which buckets that rewrote.

    The newest ``order_col`` of a key wins and the increment wins ties; NULL is a key like any other. The buckets that
    hold a key of the increment are read once and written anew, the others are neither opened nor listed into. An empty
    increment changes nothing. Merging the same increment again gives the same rows.
    """
    count = bucket_count(spark, path, buckets)
    root = f"{path}/base-{count}"
    newest = latest_per_key(rows.select(*schema.names), keys, [F.desc(order_col), *ties])
    newest = materialize(newest.withColumn(BUCKET, bucket_of(keys, count)), "newest")
    touched = sorted(r[0] for r in newest.select(BUCKET).distinct().collect())
    if not touched:
        return []
    current = current_folders(spark, root)
    held = read_folders(spark, root, schema, [current[b] for b in touched if b in current])
    merged = latest_per_key(tagged_union(held, newest), keys, [F.desc(order_col), F.desc(OC)]).drop(OC)
    write_fold(merged, root, next_fold(spark, root))
    drop_superseded(spark, root, keep)
    return touched
