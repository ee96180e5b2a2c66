"""Joins with one key holding a third of all rows, and the plans operators must keep."""

import pytest
from pyspark.sql import functions as F

from beaconry import schemas
from beaconry.operators import joins as j
from beaconry.operators import lookup as lk
from beaconry.operators import merge as mg
from beaconry.operators.aggregates import servers_by_app
from beaconry.operators.skew import fits_broadcast, measured_bytes, part_of, sized_join
from beaconry.queries.adapters import Tables
from beaconry.sources import messages as m
from beaconry.sources.extract import incremental_extract
from beaconry.sources.tables import overwrite_partitions, read_partition_range
from tests.helpers import plan, rows

N = 30_000


@pytest.fixture(scope="module")
def fact(spark):
    """A third of the rows on one host, a tenth without a host, the rest spread over many."""
    host = (F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None)
            .otherwise(F.concat(F.lit("h"), F.col("id") % 500)))
    return spark.range(N).select("id", host.alias("hostname"))


@pytest.fixture(scope="module")
def dim(spark):
    names = spark.range(400).select(F.concat(F.lit("h"), "id").alias("hostname"), "id")
    return names.unionByName(spark.createDataFrame([("hot", 1000)], "hostname string, id long")).withColumnRenamed("id", "server_id")


@pytest.mark.parametrize("limit", [None, 0])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_is_the_same_whatever_the_size(shuffled, fact, dim, how, limit):
    joined = sized_join(fact, dim, ["hostname"], how, limit=limit)
    assert joined.columns == (["id", "hostname", "server_id"] if how in ("inner", "left") else ["id", "hostname"])
    assert ("BroadcastHashJoin" in plan(joined)) == (limit is None)
    plain = fact.join(dim, "hostname", how)
    assert rows(joined) == rows(plain, *joined.columns)


def test_null_keys_can_be_equal(spark):
    left = spark.createDataFrame([(1, None), (2, "a"), (3, "b")], "id long, k string")
    right = spark.createDataFrame([(None, 7), ("a", 8)], "k string, v long")
    for limit in (None, 0):
        assert rows(sized_join(left, right, ["k"], null_safe=True, limit=limit)) == [(1, None, 7), (2, "a", 8)]
        assert rows(sized_join(left, right, ["k"], limit=limit)) == [(2, "a", 8)]


def test_spark_splits_a_hot_key(shuffled, fact, dim):
    """The adaptive rule that hot keys are left to applies to the plans of this join."""
    spark = shuffled
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        wide = fact.repartition(8).withColumn("text", F.sha2(F.col("id").cast("string"), 512))
        for how in ("inner", "left", "left_semi", "left_anti"):
            joined = sized_join(wide, dim.repartition(4), ["hostname"], how, limit=0)
            joined.collect()
            assert "SortMergeJoin(skew=true)" in plan(joined)
    finally:
        for k in settings:
            spark.conf.unset(k)


@pytest.mark.parametrize("limit", [None, 0])
def test_operators_keep_rows_and_column_order_at_any_size(shuffled, limit):
    spark = shuffled
    table = spark.range(3000).selectExpr("id AS n", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id END AS id", "id * 2 AS z")
    keys = spark.createDataFrame([(7,), (10,), (None,)], "id long")
    kept = j.delete_keys(table, keys, ["id"], limit=limit)
    assert kept.columns == ["n", "id", "z"]
    assert rows(kept) == rows(table.filter("id IS NULL OR id NOT IN (7, 10)"))
    found = lk.lookup_by_id(table, keys, limit=limit)
    assert found.columns == ["n", "id", "z"] and rows(found) == rows(table.filter("id IN (7, 10)"))
    full = spark.createDataFrame([(1, 2, "a"), (None, 1, "b"), (3, 9, "c"), (5, None, "d"), (6, 4, "e")], "id long, update_time long, v string")
    delta = spark.createDataFrame([(None, 2, "B"), (1, 2, "A"), (3, 8, "C"), (5, 1, "D"), (6, None, "E"), (7, 1, "F"), (7, 2, "G")],
                                  "id long, update_time long, v string")
    want = [(1, 2, "A"), (3, 9, "c"), (5, 1, "D"), (6, 4, "e"), (7, 2, "G"), (None, 2, "B")]
    for unique in (True, False):
        merged = mg.merge_latest(full, delta, ["id"], full_is_unique=unique, limit=limit)
        assert merged.columns == ["id", "update_time", "v"] and rows(merged) == sorted(want, key=repr)


def test_size_decides_the_broadcast(spark, fact, dim):
    assert 0 < measured_bytes(dim) < 100_000
    assert fits_broadcast(dim) and not fits_broadcast(dim, 10)
    assert "BroadcastHashJoin" in plan(sized_join(fact, dim, ["hostname"]))


def test_a_part_is_bounded_by_its_whole(spark):
    whole = spark.range(10)
    part = part_of(whole.filter("id > 3"), whole)
    measured_bytes(whole)
    jobs = spark.sparkContext.statusTracker()
    before = len(jobs.getJobIdsForGroup(None))
    assert fits_broadcast(part)
    assert len(jobs.getJobIdsForGroup(None)) == before


def test_point_in_time_join_on_a_hot_host(shuffled, fact):
    spark = shuffled
    timed = fact.withColumn("timestamp", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 60))
    cut = "TIMESTAMP '2024-01-08'"
    hosts = spark.sql(f"SELECT 'hot' AS hostname, 1L AS dwid, TIMESTAMP '2023-01-01' AS valid_from, {cut} AS valid_to "
                      f"UNION ALL SELECT 'hot', 2L, {cut}, NULL UNION ALL SELECT 'h1', 3L, {cut}, NULL")
    on, take = {"hostname": "hostname"}, {"server_dwid": "dwid"}
    joined = j.pit_join(timed, hosts, on, take, limit=0)
    early = F.col("timestamp") < F.expr(cut)
    expected = timed.filter("hostname = 'hot'").select("id", F.when(early, 1).otherwise(2).cast("long").alias("server_dwid")).unionByName(
        timed.filter((F.col("hostname") == "h1") & ~early).select("id", F.lit(3).cast("long").alias("server_dwid")))
    assert rows(joined, "id", "server_dwid") == rows(expected)
    missed = j.unmatched_facts(timed, hosts, on, limit=0)
    assert missed.count() + joined.count() == N


def test_lifted_dimension_equals_two_joins(spark):
    server = spark.sql("SELECT 1L AS dwid, 's' AS hostname, 9L AS app_id, TIMESTAMP '2024-01-01' AS valid_from, TIMESTAMP '2024-01-10' AS valid_to "
                       "UNION ALL SELECT 2L, 's', 9L, TIMESTAMP '2024-01-10', NULL")
    app = spark.sql("SELECT 5L AS dwid, 9L AS id, TIMESTAMP '2024-01-03' AS valid_from, TIMESTAMP '2024-01-12' AS valid_to "
                    "UNION ALL SELECT 6L, 9L, TIMESTAMP '2024-01-12', NULL")
    events = spark.range(20).select("id", F.lit("s").alias("hostname"), F.expr("TIMESTAMP '2024-01-01' + make_dt_interval(CAST(id AS INT))").alias("timestamp"))
    hosts = j.lift_dimension(server, app, {"app_id": "id"}, {"app_dwid": "dwid"})
    once = j.pit_join(events, hosts, {"hostname": "hostname"}, {"server_dwid": "dwid", "app_dwid": "app_dwid"})
    twice = j.pit_join(events, server, {"hostname": "hostname"}, {"server_dwid": "dwid", "app_id": "app_id"})
    twice = j.pit_join(twice, app, {"app_id": "id"}, {"app_dwid": "dwid"})
    assert rows(once, "id", "server_dwid", "app_dwid") == rows(twice, "id", "server_dwid", "app_dwid")
    assert once.count() == 18


def test_servers_of_a_hot_app_are_rows(spark):
    servers = spark.range(9000).select("id", F.when(F.col("id") % 3 < 2, 1).otherwise(F.col("id")).cast("long").alias("app_id"))
    members = servers_by_app(servers.unionByName(servers))
    assert rows(members) == rows(servers, "app_id", "id")


def test_filters_reach_the_scan(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    text = plan(incremental_extract(t.metric, "timestamp", "2024-01-10", "2024-01-20").select("id"), "formatted")
    assert "GreaterThanOrEqual(ts,2024-01-10" in text and "LessThan(ts,2024-01-20" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp>" in text


def test_one_row_per_key_leaves_each_task(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    text = plan(mg.latest_per_key(t.changes, ["id"], [F.desc("update_time"), F.desc("tie")]))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_a_message_is_parsed_once(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    text = plan(m.accepted(m.decode_metric(m.to_messages(t.metric, "cu"))))
    assert text.count("from_json") == 1


def test_partition_filter_prunes(spark, tmp_path):
    t = Tables(spark, "/root/testdata/sf0.001")
    overwrite_partitions(t.dated_metric, str(tmp_path), ["creation_date"])
    schema = schemas.extend(schemas.METRIC, creation_date=schemas.STR)
    text = plan(read_partition_range(spark, str(tmp_path), schema, "creation_date", "2024-01-05", "2024-01-06"), "formatted")
    assert "PartitionFilters: [isnotnull(creation_date" in text and "(creation_date#" in text
