"""Dimensions stored by key bucket and by the year their versions ended.

A day's changes reach the open versions of their keys and versions that end later than the earliest change; only those
partitions of the touched buckets are read and written, so years that are closed stay as they are. A dimension's folder
holds ``base-B/fold=S/bucket=K/ended=Y`` (open versions under ``OPEN``), a note per fold on what it replaces, and the
largest surrogate key so far.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconry.operators.scd2 import scd2_apply
from beaconry.sources.buckets import BUCKET, BUCKETS, FOLD, KEPT_FOLDS, MARKED, bucket_count, bucket_of, finished, next_fold
from beaconry.sources.files import delete, listed, read_text, write_text

ENDED = "ended"
# fixed value: the year that stands for versions that have not ended
OPEN = 9999
Parts = dict[tuple[int, int], str]


def _parts(spark: SparkSession, root: str, upto: int | None = None) -> Parts:
    """The folder of each (bucket, year) as of a fold: what a fold replaces counts only from there, or is gone."""
    current: Parts = {}
    for fold, path in finished(spark, root, FOLD).items():
        if upto is not None and fold > upto:
            break
        note = json.loads(read_text(spark, f"{root}/replaces-{fold}") or "{}")
        for bucket, year in list(current):
            if bucket in note["buckets"] and year >= note["since"]:
                del current[bucket, year]
        for bucket, folder in listed(spark, path, f"{BUCKET}=").items():
            current |= {(int(bucket), int(year)): p for year, p in listed(spark, folder, f"{ENDED}=").items()}
    return current


def _read(spark: SparkSession, root: str, schema: T.StructType, folders: Sequence[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType()), T.StructField(ENDED, T.IntegerType())])
    return spark.read.schema(stored).option("basePath", root).parquet(*folders).select(*schema.names)


def read_dimension(spark: SparkSession, path: str, schema: T.StructType, upto: int | None = None, since: str | None = None) -> DataFrame:
    """A dimension as it is now, or as of a fold that is still kept; no rows before the first.

    With ``since`` only versions that can be valid at that day or later are read: the years closed before are not opened.
    """
    root = f"{path}/base-{bucket_count(spark, path, 0)}"
    year = int(since[:4]) if since else 0
    return _read(spark, root, schema, [p for (_, ended), p in sorted(_parts(spark, root, upto).items()) if ended >= year])


def _highest(spark: SparkSession, root: str, schema: T.StructType) -> int:
    """The largest surrogate key: from the note of the newest fold, or from the table if a stopped run left none."""
    newest = max(finished(spark, root, FOLD), default=0)
    note = read_text(spark, f"{root}/highest-{newest}") if newest else "0"
    if note is not None:
        return int(note)
    return _read(spark, root, schema, list(_parts(spark, root).values())).agg(F.coalesce(F.max("dwid"), F.lit(0))).first()[0]


def apply_changes(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], changes: DataFrame,
                  date_col: str = "update_date", latest_by: Sequence[str] = (), buckets: int = BUCKETS, keep: int = KEPT_FOLDS,
                  limit: int | None = None) -> list[int]:
    """Bring a stored dimension up to date by the rules of ``scd2_apply``, and say which buckets that rewrote.

    Versions of a key follow each other without gaps, so a change meets those that end in its year or later and no
    other. A change that comes years late rewrites its buckets from that year on.
    """
    count = bucket_count(spark, path, buckets)
    root = f"{path}/base-{count}"
    reach = changes.groupBy(bucket_of(keys, count).alias(BUCKET)).agg(F.min(date_col).alias("first")).collect()
    if not reach:
        return []
    touched, since = sorted(r[BUCKET] for r in reach), int(min(r["first"] for r in reach)[:4])
    held = _read(spark, root, schema, [p for (b, year), p in _parts(spark, root).items() if b in touched and year >= since])
    highest = _highest(spark, root, schema)
    done = scd2_apply(held, changes, keys, date_col, latest_by, limit=limit, highest=highest).select(*schema.names)
    fold = next_fold(spark, root)
    # the note comes first; it counts once the fold is committed
    write_text(spark, f"{root}/replaces-{fold}", json.dumps({"buckets": touched, "since": since}))
    placed = done.withColumn(BUCKET, bucket_of(keys, count)).withColumn(ENDED, F.coalesce(F.year("valid_to"), F.lit(OPEN)))
    placed.hint("rebalance", BUCKET, ENDED).write.option(MARKED, "true").partitionBy(BUCKET, ENDED).parquet(f"{root}/{FOLD}={fold}")
    top = spark.read.schema(schema).parquet(f"{root}/{FOLD}={fold}").agg(F.coalesce(F.max("dwid"), F.lit(0))).first()[0]
    write_text(spark, f"{root}/highest-{fold}", str(max(top, highest)))
    _drop_superseded(spark, root, keep)
    return touched


def _drop_superseded(spark: SparkSession, root: str, keep: int) -> None:
    """Remove what none of the newest folds needs, and what was never finished."""
    folds = finished(spark, root, FOLD)
    recent = list(folds)[-keep - 1:]
    live = {p for fold in recent for p in _parts(spark, root, fold).values()}
    for fold, path in listed(spark, root, f"{FOLD}=").items():
        if int(fold) in recent or int(fold) > max(folds):
            continue
        left = 0
        for folder in listed(spark, path, f"{BUCKET}=").values():
            for part in listed(spark, folder, f"{ENDED}=").values():
                if part in live:
                    left += 1
                else:
                    delete(spark, part)
        if not left:
            delete(spark, path)
            delete(spark, f"{root}/replaces-{fold}")
            delete(spark, f"{root}/highest-{fold}")
