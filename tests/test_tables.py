"""Table writes that replace, overwrite, land and create; and connector settings."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from beaconry import schemas
from beaconry.operators.merge import merge_latest
from beaconry.session import fresh_path, materialize, shared_folder
from beaconry.sources import buckets, database, messages
from beaconry.sources import tables as st
from beaconry.sources.extract import date_range, incremental_extract, trailing_window
from tests.helpers import at, rows


def test_replace_a_table_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "id long, n long"
    st.replace_table(spark.createDataFrame([(1, 1), (2, 2)], schema), path)
    for _ in range(3):
        current = st.read_table(spark, path, spark.createDataFrame([], schema).schema)
        st.replace_table(current.withColumn("n", F.col("n") * 2), path)
    current = st.read_table(spark, path, current.schema)
    assert rows(current) == [(1, 8), (2, 16)]
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["v=3", "v=4"]


def test_an_unfinished_version_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1,)], "id long")
    st.replace_table(df, path)
    spark.createDataFrame([(9,)], "id long").write.parquet(f"{path}/v=2")
    (tmp_path / "t" / "v=2" / "_SUCCESS").unlink()
    assert rows(st.read_table(spark, path, df.schema)) == [(1,)]
    st.replace_table(spark.createDataFrame([(3,)], "id long"), path)
    assert rows(st.read_table(spark, path, df.schema)) == [(3,)]


def test_a_missing_table_is_empty(spark, tmp_path):
    assert st.read_table(spark, str(tmp_path / "none"), schemas.MASTER["app"]).count() == 0


@pytest.mark.parametrize("rebalance", [False, True])
def test_only_present_partitions_are_replaced(spark, tmp_path, rebalance):
    path = str(tmp_path)
    schema = "id long, d string"
    st.overwrite_partitions(spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], schema), path, ["d"], rebalance)
    st.overwrite_partitions(spark.createDataFrame([(3, "2024-01-02"), (4, "2024-01-03")], schema), path, ["d"], rebalance)
    table = spark.read.schema(schema).parquet(path)
    assert rows(table) == [(1, "2024-01-01"), (3, "2024-01-02"), (4, "2024-01-03")]
    parts = st.read_partition_range(spark, path, table.schema, "d", "2024-01-02", "2024-01-03")
    assert rows(parts) == [(3, "2024-01-02")]


def test_compaction_keeps_rows_and_reduces_files(spark, tmp_path):
    df = spark.range(1000, numPartitions=20).select("id", F.lit("2024-01-01").alias("d"))
    st.overwrite_partitions(df, str(tmp_path), ["d"])
    count = lambda: len(list((tmp_path / "d=2024-01-01").glob("*.parquet")))
    before = count()
    st.compact_partitions(spark, str(tmp_path), df.schema, "d", "2024-01-01", "2024-01-02")
    assert count() < before
    assert spark.read.schema(df.schema).parquet(str(tmp_path)).distinct().count() == 1000


def test_landing_keeps_times_as_text(spark, tmp_path):
    df = spark.createDataFrame([(1, at("2024-01-01 10:00:00"))], "id long, t timestamp")
    assert rows(st.land_extract(df, str(tmp_path / "l"))) == [(1, "2024-01-01 10:00:00")]
    again = st.land_extract(df.limit(0), str(tmp_path / "l"))
    assert again.count() == 0 and dict(again.dtypes)["t"] == "string"


def test_layer_lifecycle(spark, tmp_path):
    names = st.create_tables(spark, "dmt", str(tmp_path / "dmt"))
    try:
        assert set(names) == {f"dmt.{t}" for t in schemas.LAYERS["dmt"]}
        assert spark.table("dmt.wide_metric_avg").columns == schemas.WIDE_METRIC_AVG.names
        row = spark.createDataFrame([(1, 1, 1, 1, 1, 50, "GREEN", "2024-01-01")], schemas.SUM_METRIC_AVG)
        st.insert_table(row, "dmt.sum_metric_avg")
        st.insert_table(row.withColumn("creation_date", F.lit("2024-01-02")), "dmt.sum_metric_avg")
        assert spark.table("dmt.sum_metric_avg").count() == 2
        st.truncate_tables(spark, "dmt")
        assert spark.table("dmt.sum_metric_avg").count() == 0
    finally:
        st.drop_tables(spark, "dmt")
    assert not spark.catalog.databaseExists("dmt")


def test_range_bounds(spark):
    df = spark.createDataFrame([(i, at(f"2024-01-01 00:00:0{i}")) for i in range(6)], "id long, ts timestamp")
    ids = lambda d: [r[0] for r in rows(d, "id")]
    pick = lambda closed: ids(incremental_extract(df, "ts", "2024-01-01 00:00:01", "2024-01-01 00:00:03", closed))
    assert (pick("both"), pick("left"), pick("right"), pick("neither")) == ([1, 2, 3], [1, 2], [2, 3], [2])
    assert ids(trailing_window(df, "ts", "2024-01-01 00:00:05", 5)) == [1, 2, 3, 4, 5]
    assert ids(trailing_window(df, "ts", "2024-01-01 00:00:05", 5, "neither")) == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        date_range(df, "id", "1", "2", "open")


def test_jdbc_and_kafka_settings(spark):
    options = database.jdbc_options("jdbc:x", "metric_threshold", (1, 100), 4)
    assert options["partitionColumn"] == "server_id" and options["numPartitions"] == "4"
    kafka = messages.trunk_options("b:1", ["cpu.usage", "alert"])
    assert kafka == {"kafka.bootstrap.servers": "b:1", "subscribe": "cpu.usage,alert", "startingOffsets": "latest",
                     "maxOffsetsPerTrigger": "10000000"}


def test_scratch_is_under_the_shared_folder(spark):
    assert fresh_path(spark, "x").startswith(shared_folder(spark))


KEYED = schemas.struct(id=schemas.LONG, v=schemas.STR, update_time=schemas.TS)


def test_bucket_merges_equal_the_plain_merge_and_touch_no_other_bucket(spark, tmp_path):
    r = random.Random(8)
    path = str(tmp_path / "table")
    time = lambda: None if r.random() < 0.1 else datetime(2024, 1, 1 + r.randrange(5))
    key = lambda n: None if n == 0 else n
    plain = spark.createDataFrame([], KEYED)
    for step, ids in enumerate((range(60), range(50, 80), [3, 3, 7, 0], [], [200])):
        delta = spark.createDataFrame([(key(i), f"s{step}-{n}", time()) for n, i in enumerate(ids)], KEYED)
        before = buckets.current_folders(spark, f"{path}/base-16")
        touched = buckets.merge_buckets(spark, path, KEYED, ["id"], delta, ties=[F.desc("v")], buckets=16)
        plain = materialize(merge_latest(plain, delta, ["id"], ties=[F.desc("v")]), "plain")
        assert rows(buckets.read_buckets(spark, path, KEYED)) == rows(plain)
        after = buckets.current_folders(spark, f"{path}/base-16")
        assert {b for b in after if after[b] != before.get(b)} == set(touched)
        assert len(touched) <= len(set(ids))
    # the same increment again changes nothing
    buckets.merge_buckets(spark, path, KEYED, ["id"], delta, ties=[F.desc("v")])
    assert rows(buckets.read_buckets(spark, path, KEYED)) == rows(plain)


def test_an_earlier_fold_can_be_read_while_it_is_kept(spark, tmp_path):
    path = str(tmp_path / "table")
    for n in range(3):
        delta = spark.createDataFrame([(i, f"v{n}", datetime(2024, 1, 1 + n)) for i in range(10 if n == 0 else n)], KEYED)
        buckets.merge_buckets(spark, path, KEYED, ["id"], delta, buckets=4, keep=2)
    assert buckets.current_fold(spark, path) == 3
    values = [rows(buckets.read_buckets(spark, path, KEYED, upto), "v") for upto in (0, 1, 2, 3)]
    values = [[v for (v,) in part] for part in values]
    assert values[0] == [] and values[1] == ["v0"] * 10
    assert values[2] == ["v0"] * 9 + ["v1"] and values[3] == ["v0"] * 8 + ["v2"] * 2


def test_an_unfinished_fold_is_not_read(spark, tmp_path):
    path = tmp_path / "table"
    delta = spark.createDataFrame([(1, "a", datetime(2024, 1, 1))], KEYED)
    buckets.merge_buckets(spark, str(path), KEYED, ["id"], delta, buckets=4)
    half = path / "base-4" / "fold=2" / "bucket=0"
    half.mkdir(parents=True)
    (half / "part-0.parquet").write_text("being written")
    assert rows(buckets.read_buckets(spark, str(path), KEYED), "v") == [("a",)]
    buckets.merge_buckets(spark, str(path), KEYED, ["id"], delta.withColumn("v", F.lit("b")))
    assert rows(buckets.read_buckets(spark, str(path), KEYED), "v") == [("b",)] and not half.exists()
