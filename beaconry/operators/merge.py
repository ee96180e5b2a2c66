"""Latest-row merges of a full table with an increment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beaconry.operators.skew import part_of, sized_join
from beaconry.session import materialize

OC, RANK = "oc", "__rank"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``.

    Filtering the row number to 1 lets Spark keep one row per key before the shuffle,
    so a key with very many rows never reaches one task whole.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(window)).filter(F.col(RANK) == 1).drop(RANK)


def tagged_union(full: DataFrame, delta: DataFrame) -> DataFrame:
    """Both inputs in one frame; ``oc`` is 0 for the full table and 1 for the increment."""
    columns = full.columns
    return full.withColumn(OC, F.lit(0)).unionByName(delta.select(*columns).withColumn(OC, F.lit(1)))


def merge_latest(
    full: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    order_col: str = "update_time",
    ties: Sequence[Column] = (),
    full_is_unique: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """One current row per key: newest ``order_col`` wins, the increment wins ties, and NULL is a key like any other.

    With ``full_is_unique`` the full table is itself a merge result, so only the increment is reduced to one row per
    key; each full row then meets the increment's row of its key, and the newer one stays. The full table
    is not shuffled while the reduced increment is small enough to broadcast, and the rows are the same either way.
    """
    if not full_is_unique:
        return latest_per_key(tagged_union(full, delta), keys, [F.desc(order_col), F.desc(OC), *ties]).drop(OC)
    columns = full.columns
    # written, as three steps below read it
    newest = materialize(latest_per_key(delta.select(*columns), keys, [F.desc(order_col), *ties]), "newest")
    offered = newest.select(*keys, F.struct(*columns).alias("__new"))
    met = sized_join(full, part_of(offered, newest), keys, "left", limit=limit, null_safe=True)
    renewed = F.col("__new").isNotNull() & F.coalesce(
        F.col(f"__new.{order_col}") >= F.col(order_col), F.col(order_col).isNull())
    kept = met.select(*[F.when(renewed, F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) for c in columns])
    # no more keys than the increment has
    held = sized_join(full.select(*keys), part_of(newest.select(*keys), newest), keys, "left_semi", limit=limit, null_safe=True)
    held = part_of(held.distinct(), newest)
    return kept.unionByName(sized_join(newest, held, keys, "left_anti", limit=limit, null_safe=True))
