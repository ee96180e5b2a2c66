"""Parallel incremental reads from a relational source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from beaconry.sources.extract import incremental_extract

# fixed values: the column each source table is split by
SPLIT_COLUMNS = {
    "app": "id",
    "server": "id",
    "metric_index": "id",
    "metric_threshold": "server_id",
    "metric": "id",
}
TIME_COLUMNS = {"metric": "timestamp"}


def jdbc_options(url: str, table: str, bounds: tuple[int, int], partitions: int) -> dict[str, str]:
    low, high = bounds
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": SPLIT_COLUMNS[table],
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
        "pushDownPredicate": "true",
    }


def jdbc_extract(
    spark: SparkSession,
    url: str,
    table: str,
    start: str,
    end: str,
    bounds: tuple[int, int],
    partitions: int = 8,
    closed: str = "left",
    **options: str,
) -> DataFrame:
    """Read one time range of a source table in ``partitions`` parallel queries split by key.

    The time filter is pushed into each query. ``bounds`` are the smallest and largest
    split key, needed only to place the splits: keys outside them are still read.
    """
    reader = spark.read.format("jdbc").options(**jdbc_options(url, table, bounds, partitions), **options)
    return incremental_extract(reader.load(), TIME_COLUMNS.get(table, "update_time"), start, end, closed)
