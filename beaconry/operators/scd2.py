"""Type-2 slowly changing dimensions at day grain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beaconry.operators.merge import latest_per_key
from beaconry.operators.numbering import max_key, number_rows
from beaconry.operators.skew import part_of, sized_join
from beaconry.session import materialize

VALIDITY = ("valid_from", "valid_to", "eff_flag")
IS_CHANGE = "__is_change"
MATCHED = "__changed_on"


def change_set(src: DataFrame, columns: Sequence[str], start: str, end: str, date_col: str = "update_date") -> DataFrame:
    """Business columns of the increments in ``[start, end)``, with the day they changed."""
    return src.filter((F.col(date_col) >= start) & (F.col(date_col) < end)).select(*columns, date_col)


def match_changes(dim: DataFrame, changes: DataFrame, keys: Sequence[str], date_col: str = "update_date",
                  limit: int | None = None) -> DataFrame:
    """Every dimension row with the day of each change to its key, NULL where there is none.

    Several changes to one key give several rows; reduce the changes to one row
    per key first where that is unwanted. The changes are the side that may have a key
    with very many rows, so they are the large side of the join; unmatched rows are added apart.
    """
    days = changes.select(*keys, F.col(date_col).alias(MATCHED))
    matched = sized_join(days, dim, keys, "inner", limit=limit)
    others = sized_join(dim, changes.select(*keys).distinct(), keys, "left_anti", limit=limit)
    columns = [*dim.columns, MATCHED]
    return matched.select(*columns).unionByName(others.withColumn(MATCHED, F.lit(None).cast("string")).select(*columns))


def close_matched(matched: DataFrame) -> DataFrame:
    """Close the effective rows that were matched by a change; leave all others as they are."""
    hit = F.col("eff_flag") & F.col(MATCHED).isNotNull()
    return matched.select(
        *[c for c in matched.columns if c not in (*VALIDITY, MATCHED)],
        "valid_from",
        F.when(hit, F.to_timestamp(MATCHED)).otherwise(F.col("valid_to")).alias("valid_to"),
        F.when(hit, F.lit(False)).otherwise(F.col("eff_flag")).alias("eff_flag"),
    )


def open_versions(changes: DataFrame, date_col: str = "update_date") -> DataFrame:
    """A new effective version from each change row, without its surrogate key."""
    return changes.select(
        *[c for c in changes.columns if c != date_col],
        F.to_timestamp(date_col).alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("eff_flag"),
    )


def union_versions(closed: DataFrame, opened: DataFrame) -> DataFrame:
    return closed.unionByName(opened)


def with_max_key(changes: DataFrame, dim: DataFrame) -> DataFrame:
    """Each change with the largest surrogate key so far, as a scalar subquery instead of a cross join."""
    return changes.withColumn("max_id", max_key(dim).scalar())


def day_changes(changes: DataFrame, keys: Sequence[str], date_col: str = "update_date",
                latest_by: Sequence[str] = ()) -> DataFrame:
    """The last change of each key on each day, ``latest_by`` naming the columns that tell which is last.

    At day grain earlier changes of the same day would be versions of zero length.
    Afterwards a key has at most one row per day, which bounds every window below.
    """
    order = [F.desc(c) for c in latest_by] or [F.desc(date_col)]
    return latest_per_key(changes, [*keys, date_col], order)


def chain_versions(versions: DataFrame, keys: Sequence[str], attrs: Sequence[str],
                   ties: Sequence[str] = (), droppable: Column | None = None) -> DataFrame:
    """End each version where the next of its key begins; the last one stays open and effective.

    Rows under ``droppable`` are first removed where they repeat the attributes of the
    version before them.
    """
    window = W.partitionBy(*keys).orderBy("valid_from", *ties)
    if droppable is not None:
        values = F.struct(*attrs)
        versions = (
            versions.withColumn("__before", F.lag(values).over(window))
            .filter(~droppable | F.col("__before").isNull() | ~F.col("__before").eqNullSafe(values))
            .drop("__before")
        )
    following = F.lead("valid_from").over(window)
    return versions.withColumn("valid_to", following).withColumn("eff_flag", F.col("valid_to").isNull())


def scd2_apply(
    dim: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    date_col: str = "update_date",
    latest_by: Sequence[str] = (),
    skip_unchanged: bool = True,
    compat: bool = False,
    limit: int | None = None,
    highest: int | None = None,
) -> DataFrame:
    """Bring a dimension up to date with a set of changes.

    The versions of each changed key and its new versions form one timeline ordered by
    ``valid_from``: each version ends where the next begins and the last one is
    effective. Several changes to a key, late days and reruns therefore leave one open
    version and no overlaps. Keys without changes pass through without a shuffle while
    the changed keys are few enough to broadcast. New versions are numbered after ``highest``, or
    after the largest key of ``dim`` if it is not given.

    ``compat`` applies the changes one by one against the effective row instead: several
    changes to one key repeat its closed version and leave several versions open, and a
    rerun adds versions again.
    """
    keys, columns = list(keys), dim.columns
    attrs = [c for c in columns if c not in ("dwid", *keys, *VALIDITY)]
    business = [*keys, *attrs, date_col]
    highest = max_key(dim).scalar() if highest is None else highest

    if compat:
        closed = close_matched(match_changes(dim, changes, keys, date_col, limit))
        opened = open_versions(changes.select(*business), date_col)
        numbered = number_rows(opened, [*keys, "valid_from", *attrs], highest)
        return union_versions(closed.select(*columns), numbered.select(*columns))

    # read once, however many steps below use them
    daily = materialize(day_changes(changes, keys, date_col, latest_by).select(*business), "day-changes")
    touched_keys = part_of(daily.select(*keys).distinct(), daily)
    touched = sized_join(dim, touched_keys, keys, "left_semi", limit=limit)
    untouched = sized_join(dim, touched_keys, keys, "left_anti", limit=limit)
    added = open_versions(daily, date_col).withColumn("dwid", F.lit(None).cast("long"))
    timeline = union_versions(touched.withColumn(IS_CHANGE, F.lit(False)), added.withColumn(IS_CHANGE, F.lit(True)))
    chained = materialize(
        chain_versions(timeline, keys, attrs, [IS_CHANGE, "dwid"], F.col(IS_CHANGE) if skip_unchanged else None),
        "versions",
    )
    kept = chained.filter(~F.col(IS_CHANGE))
    numbered = number_rows(chained.filter(IS_CHANGE).drop("dwid", IS_CHANGE), [*keys, "valid_from"], highest)
    return untouched.unionByName(kept.select(*columns)).unionByName(numbered.select(*columns))


def scd2_from_history(
    changes: DataFrame,
    keys: Sequence[str],
    date_col: str = "update_date",
    latest_by: Sequence[str] = (),
    attrs: Sequence[str] | None = None,
    skip_unchanged: bool = True,
) -> DataFrame:
    """Rebuild a dimension from all increments ever landed."""
    keys = list(keys)
    attrs = [c for c in changes.columns if c not in (*keys, date_col, *latest_by)] if attrs is None else list(attrs)
    daily = day_changes(changes, keys, date_col, latest_by).select(*keys, *attrs, date_col)
    versions = chain_versions(open_versions(daily, date_col), keys, attrs, (), F.lit(True) if skip_unchanged else None)
    return number_rows(versions, [*keys, "valid_from"])
