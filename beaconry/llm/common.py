"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: the white space that separates words and surrounds lines, and the letters that are folded
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def fold_case(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, **own: Column) -> DataFrame:
    """The whole input row as the struct ``row`` beside an operator's own columns.

    Whatever the input's extra columns are called, they cannot clash with an operator's columns.
    """
    return df.select(F.struct(*[quoted(c) for c in df.columns]).alias("row"), *[c.alias(n) for n, c in own.items()])


def unpacked(df: DataFrame, columns: list[str], changed: dict[str, Column], added: dict[str, Column]) -> DataFrame:
    """The columns of ``row`` again, some of them changed, then the added ones.

    An added column takes the place of an input column of the same name.
    """
    kept = [changed.get(c, F.col("row")[c]).alias(c) for c in columns if c not in added]
    return df.select(*kept, *[c.alias(n) for n, c in added.items()])


def wide_hash(*values: Column) -> list[Column]:
    """128 bits of a value as two longs; the second is seeded by a fixed leading value."""
    return [F.xxhash64(*values), F.xxhash64(F.lit(20011), *values)]


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand Python workers that many rows at a time, in the jobs run within: whole texts of many rows take memory twice."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
