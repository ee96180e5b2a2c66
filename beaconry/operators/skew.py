"""Joins that measure before they choose: broadcast a side of known size, else shuffle and let Spark split hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# largest side, in estimated in-memory bytes, that is sent whole to every executor
BROADCAST_LIMIT = 64 * 1024 * 1024

# types whose values differ in size; all others take 8 bytes in a row
VARYING = (T.StringType, T.BinaryType, T.MapType, T.ArrayType, T.StructType)

# sizes already measured, and frames known to be no larger than another one
_SIZES: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()
_WHOLE: WeakKeyDictionary[DataFrame, DataFrame] = WeakKeyDictionary()


def _width(field: T.StructField) -> Column:
    c = F.col(field.name)
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(16)
    return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + F.lit(64)


def measure(*frames: DataFrame) -> None:
    """Measure several frames in one job, each by its own fully partial-aggregated pass."""
    todo = [df for df in dict.fromkeys(frames) if df not in _SIZES]
    if not todo:
        return
    passes = []
    for i, df in enumerate(todo):
        varying = [f for f in df.schema.fields if isinstance(f.dataType, VARYING)]
        width = F.lit(8 + 8 * (len(df.schema.fields) - len(varying)))
        for field in varying:
            width = width + _width(field)
        passes.append(df.select(width.cast("long").alias("w")).agg(F.lit(i).alias("i"), F.coalesce(F.sum("w"), F.lit(0)).alias("n")))
    for row in reduce(DataFrame.unionAll, passes).collect():
        _SIZES[todo[row["i"]]] = row["n"]


def measured_bytes(df: DataFrame) -> int:
    """Bytes the rows of a frame would take in memory."""
    measure(df)
    return _SIZES[df]


def part_of(part: DataFrame, whole: DataFrame) -> DataFrame:
    """Note that ``part`` is a filter or projection of ``whole``, so a size measured for the whole bounds it."""
    _WHOLE[part] = whole
    return part


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """Whether the rows are known to fit: the frame itself, or one it is part of, measures within the limit."""
    limit = BROADCAST_LIMIT if limit is None else limit
    if limit <= 0:
        return False
    whole = _WHOLE.get(df)
    return (whole is not None and fits_broadcast(whole, limit)) or measured_bytes(df) <= limit


def task_parts(spark: SparkSession, rows: int, most: int) -> int:
    """The usual number of shuffle partitions, or as many as leave a task at ``most`` rows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // most))


def broadcast_if_small(df: DataFrame, limit: int | None = None) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df, limit) else df


def sized_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    residual: Column | None = None,
    limit: int | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Join a large side to a smaller one on equal keys plus an optional residual condition.

    The smaller side is broadcast when its measured size is within ``limit``. Beyond it both sides are shuffled, and
    Spark's adaptive skew join splits a key that fills a partition; for that the smaller side should be a scan or a
    written table, not an aggregate over the join keys. With ``null_safe`` two NULL keys are equal.
    Only the ``on`` columns may share names. ``how`` is inner, left, left_semi or left_anti. Either way the result has
    the columns of ``fact`` in their order, then those of ``dim`` but the keys.
    """
    on = list(on)
    renamed = dim.withColumnsRenamed({k: f"__{k}" for k in on})
    right = F.broadcast(renamed) if fits_broadcast(dim, limit) else renamed
    condition = residual if residual is not None else F.lit(True)
    for k in on:
        left, other = F.col(k), F.col(f"__{k}")
        condition = (left.eqNullSafe(other) if null_safe else left == other) & condition
    return fact.join(right, condition, how).drop(*[f"__{k}" for k in on])
