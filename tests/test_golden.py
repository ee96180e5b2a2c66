"""The two-day master seed and the documented sample rows."""

import json
import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from beaconry import schemas
from beaconry.functions.messages import decode_server_document
from beaconry.functions.rating import gen_rag, severity
from beaconry.operators.calendar import build_dim_hour
from beaconry.operators.lookup import lookup_by_id, lookup_by_name, server_documents, server_snapshot
from beaconry.plans import daily, layers, ledger, marts
from beaconry.session import materialize, scratch
from tests.helpers import at, rows

DAY1, DAY2, DAY3 = "2018-09-01", "2018-09-02", "2018-09-03"
D1, D2 = at(DAY1), at(DAY2)

SEED1 = {
    "app": [(1, "MyCRM", "The Customer Relationship Management System", "7.0", D1, D1),
            (2, "MyOMS", "The Order Management System", "2016", D1, D1)],
    "server": [(1, 1, "svr1001", 16, 64000, D1, D1), (2, 1, "svr1002", 16, 64000, D1, D1)],
    "metric_index": [(1, "cpu.usage", "The instantaneous usage of cpu", "cpu", D1, D1),
                     (2, "mem.used", "The instantaneous value of used memory", "memory", D1, D1)],
    "metric_threshold": [(1, "cpu.usage", 80, 90, D1, D1), (1, "mem.used", 5120, 5760, D1, D1),
                         (2, "cpu.usage", 80, 90, D1, D1), (2, "mem.used", 5120, 5760, D1, D1)],
}
SEED2 = {
    "app": [(1, "MyCRM", "The Customer Relationship Management System", "7.1", D1, D2)],
    "server": [(1, 1, "svr1001", 16, 12800, D1, D2)],
    "metric_index": [(1, "cpu.usage", "The instantaneous usage percent of cpu", "cpu", D1, D2)],
    "metric_threshold": [(1, "cpu.usage", 85, 90, D1, D2)],
}
METRIC1 = [(1, "cpu.usage", "svr1001", 87, at("2018-09-01 10:34:17")), (2, "cpu.usage", "svr1001", 96, at("2018-09-01 10:50:00")),
           (3, "mem.used", "svr1002", 5000, at("2018-09-01 11:00:00")), (4, "cpu.usage", "unknown", 5, at("2018-09-01 11:00:00"))]
METRIC2 = [(5, "cpu.usage", "svr1001", 84, at("2018-09-02 00:00:00")), (6, "cpu.usage", "svr1002", 84, at("2018-09-02 23:59:59"))]


def extracts(spark, seed, metric):
    made = {t: spark.createDataFrame(seed[t], schemas.MASTER[t]) for t in schemas.MASTER_TABLES}
    return {**made, "metric": spark.createDataFrame(metric, schemas.METRIC)}


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    wh = daily.Warehouse(spark, str(tmp_path_factory.mktemp("warehouse")), buckets=4)
    daily.build_day(wh, extracts(spark, SEED1, METRIC1), DAY1, DAY2, "2018-09-02 01:00:00",
                    calendar=(f"{DAY1} 00:00:00", "2018-09-30 23:00:00"))
    daily.build_day(wh, extracts(spark, SEED2, METRIC2), DAY2, DAY3, "2018-09-03 01:00:00")
    return wh


def test_app_dimension_after_two_days(warehouse):
    dim = warehouse.current("dmt", "dim_app")
    assert rows(dim, "dwid", "id", "name", "version", "valid_from", "valid_to", "eff_flag") == [
        (1, 1, "MyCRM", "7.0", D1, D2, False),
        (2, 2, "MyOMS", "2016", D1, None, True),
        (3, 1, "MyCRM", "7.1", D2, None, True),
    ]


def test_threshold_dimension_after_two_days(warehouse):
    dim = warehouse.current("dmt", "dim_metric_threshold").filter("metric_name = 'cpu.usage'")
    assert rows(dim, "dwid", "server_id", "amber_threshold", "valid_to", "eff_flag") == [
        (1, 1, 80, D2, False), (3, 2, 80, None, True), (5, 1, 85, None, True)]


def test_current_master_rows(warehouse):
    assert rows(warehouse.current("dwh", "server"), "id", "memory") == [(1, 12800), (2, 64000)]
    assert rows(warehouse.current("dwh", "app"), "id", "version") == [(1, "7.1"), (2, "2016")]


def test_fact_rows(warehouse):
    fact = warehouse.range("dmt", "fact_metric", DAY1, DAY3)
    found = rows(fact, "id", "app_dwid", "server_dwid", "metric_index_dwid", "hour_dwid", "value", "creation_date")
    assert found == [
        (1, 1, 1, 1, 2018090110, 87, DAY1),
        (2, 1, 1, 1, 2018090110, 96, DAY1),
        (3, 1, 2, 2, 2018090111, 5000, DAY1),
        (5, 3, 3, 3, 2018090200, 84, DAY2),
        (6, 3, 2, 3, 2018090223, 84, DAY2),
    ]


def test_summary_and_wide_rows(warehouse):
    wide = warehouse.range("dmt", "wide_metric_avg", DAY1, DAY3)
    assert wide.columns == schemas.WIDE_METRIC_AVG.names
    found = rows(wide, "server_hostname", "metric_name", "db_date", "hour", "avg_value", "amber_threshold", "rag", "app_version")
    assert found == [
        ("svr1001", "cpu.usage", DAY1, 10, 92, 80, "RED", "7.0"),
        ("svr1001", "cpu.usage", DAY2, 0, 84, 85, "GREEN", "7.1"),
        ("svr1002", "cpu.usage", DAY2, 23, 84, 80, "AMBER", "7.1"),
        ("svr1002", "mem.used", DAY1, 11, 5000, 5120, "GREEN", "7.0"),
    ]


def test_rebuilding_a_day_changes_nothing(spark, warehouse):
    tables = [("dmt", f"dim_{t}") for t in schemas.MASTER_TABLES] + [("dwh", t) for t in schemas.MASTER_TABLES]
    before = {t: rows(warehouse.current(*t).drop("imported_time")) for t in tables}
    wide = rows(warehouse.range("dmt", "wide_metric_avg", DAY1, DAY3))
    daily.build_day(warehouse, extracts(spark, SEED2, METRIC2), DAY2, DAY3, "2018-09-03 05:00:00")
    assert {t: rows(warehouse.current(*t).drop("imported_time")) for t in tables} == before
    assert rows(warehouse.range("dmt", "wide_metric_avg", DAY1, DAY3)) == wide


STEPS = [f"{t}/{layer}" for t in schemas.MASTER_TABLES for layer in ("tmp", "src", "dwh", "dmt")] + [
    "hour/dmt"] + [f"metric/{s}" for s in ("tmp", "src", "dwh", "fact", "sum", "wide")]


class Stopped(Exception):
    pass


def contents(view):
    tables = [("dmt", f"dim_{t}") for t in schemas.MASTER_TABLES] + [("dwh", t) for t in schemas.MASTER_TABLES]
    return {**{t: rows(view.current(*t).drop("imported_time")) for t in tables},
            **{t: rows(view.range("dmt", t, DAY1, DAY3)) for t in ("fact_metric", "sum_metric_avg", "wide_metric_avg")}}


@pytest.fixture(scope="module")
def whole(warehouse):
    return contents(daily.Published(warehouse))


def test_a_stopped_build_goes_on(spark, tmp_path, whole):
    """Stopped after every step, a build does none twice and ends as one that was never stopped."""
    wh = daily.Warehouse(spark, str(tmp_path), buckets=4)
    calendar = (f"{DAY1} 00:00:00", "2018-09-30 23:00:00")
    daily.build_day(wh, extracts(spark, SEED1, METRIC1), DAY1, DAY2, "2018-09-02 01:00:00", calendar=calendar)
    before = contents(daily.Published(wh))
    assert before["wide_metric_avg"] and not [r for r in before["wide_metric_avg"] if DAY2 in r]
    seen = []

    def stop(name):
        seen.append(name)
        raise Stopped(name)

    for attempt in range(len(STEPS)):
        try:
            daily.build_day(wh, extracts(spark, SEED2, METRIC2), DAY2, DAY3, f"2018-09-03 {attempt + 1:02}:00:00", calendar=calendar, on_step=stop)
            break
        except Stopped:
            if attempt in (1, 5, 9):  # readers see nothing of the day
                assert contents(daily.Published(wh)) == before
    assert sorted(seen) == sorted(STEPS) and attempt >= 10
    assert contents(daily.Published(wh)) == whole
    # the import time of the first attempt stays
    assert {str(r[0]) for r in wh.range("src", "metric", DAY2, DAY3).select("imported_time").distinct().collect()} == {"2018-09-03 01:00:00"}


def test_another_token_builds_the_range_anew(spark, tmp_path):
    wh = daily.Warehouse(spark, str(tmp_path), buckets=4)
    calendar = (f"{DAY1} 00:00:00", "2018-09-30 23:00:00")
    seen = []

    def stop(name):
        seen.append(name)
        if name == "metric/wide":
            raise Stopped(name)

    with pytest.raises(Stopped):
        daily.build_day(wh, extracts(spark, SEED2, METRIC2), DAY1, DAY2, "2018-09-02 01:00:00", calendar=calendar, token="a", on_step=stop)
    daily.build_day(wh, extracts(spark, SEED1, METRIC1), DAY1, DAY2, "2018-09-02 02:00:00", calendar=calendar, token="b", on_step=seen.append)
    assert sorted(seen) == sorted(STEPS * 2)
    assert daily.Published(wh).ranges == [[DAY1, DAY2]]


def test_ranges_of_days():
    assert ledger.merged([["b", "c"], ["a", "b"], ["x", "z"], ["y", "y"]]) == [["a", "c"], ["x", "z"]]
    assert ledger.without([["a", "e"], ["x", "z"]], [["b", "c"], ["w", "y"]]) == [["a", "b"], ["c", "e"], ["y", "z"]]


def test_a_scope_leaves_the_tables_of_other_threads_alone(spark):
    """What a stream or another build writes while a build is under way stays when the build ends."""
    written, release = threading.Event(), threading.Event()
    kept = []

    def beside():
        kept.append(materialize(spark.range(5).toDF("id"), "beside"))
        written.set()
        release.wait(60)

    with scratch(spark):
        other = threading.Thread(target=beside)
        other.start()
        assert written.wait(60)
        mine = materialize(spark.range(3).toDF("id"), "mine")
        assert mine.count() == 3
    release.set()
    other.join()
    assert kept[0].count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND|FILE_NOT_EXIST|does not exist"):
        mine.count()


def test_compat_wide_repeats_rows_per_threshold_version(warehouse):
    summary = warehouse.range("dmt", "sum_metric_avg", DAY1, DAY3)
    wide = marts.build_wide_metric_avg(summary, warehouse.dims(), DAY1, DAY1, compat=True)
    assert rows(wide, "server_hostname", "amber_threshold") == [("svr1001", 80), ("svr1001", 85), ("svr1002", 5120)]


def test_hour_dimension(spark):
    hours = build_dim_hour(spark, "2018-09-01 00:00:00", "2018-09-02 00:00:00")
    assert hours.count() == 25
    row = tuple(hours.filter("dwid = 2018090110").first())
    assert row == (2018090110, "2018-09-01", at("2018-09-01 10:00:00"), 2018, 9, 1, 10, 3, 35, "Saturday", "September", True)


def test_week_numbers_follow_monday_weeks(spark):
    hours = build_dim_hour(spark, "2016-01-01 00:00:00", "2026-12-31 00:00:00").filter("hour = 0")
    for db_date, week in rows(hours, "db_date", "week"):
        assert int(datetime.fromisoformat(db_date).strftime("%W")) == week


@pytest.mark.parametrize("avg, expected", [(79, "GREEN"), (80, "AMBER"), (90, "AMBER"), (91, "RED"), (None, None)])
def test_batch_rating(spark, avg, expected):
    df = spark.createDataFrame([(avg, 80, 90)], "a int, amber int, red int")
    assert df.select(gen_rag("a", "amber", "red")).first()[0] == expected


@pytest.mark.parametrize("avg, expected", [(79.9, 0), (80.0, 1), (89.9, 1), (90.0, 2), (None, None)])
def test_stream_rating(spark, avg, expected):
    df = spark.createDataFrame([(avg, 80, 90)], "a double, amber int, red int")
    assert df.select(severity("a", "amber", "red")).first()[0] == expected


def test_server_document(spark):
    server = spark.createDataFrame(SEED1["server"], schemas.MASTER["server"])
    threshold = spark.createDataFrame(SEED1["metric_threshold"], schemas.MASTER["metric_threshold"])
    documents = server_documents(server_snapshot(server, threshold))
    ms = 1535760000000
    entry = lambda red, amber: {"redThreshold": red, "amberThreshold": amber, "creationTime": ms, "updateTime": ms}
    assert json.loads(documents.filter("id = 1").first()["document"]) == {
        "id": 1, "hostname": "svr1001", "cpuCores": 16, "memory": 64000, "appId": 1,
        "metricThresholds": {"cpu.usage": entry(90, 80), "mem.used": entry(5760, 5120)},
        "creationTime": ms, "updateTime": ms}
    back = documents.select(decode_server_document("document").alias("d")).select("d.*").filter("id = 1")
    assert back.select(F.expr("metricThresholds['mem.used'].redThreshold")).first()[0] == 5760


def test_lookups(spark):
    app = spark.createDataFrame(SEED1["app"], schemas.MASTER["app"])
    assert rows(lookup_by_id(app, spark.createDataFrame([(2,), (2,), (9,)], "id long")), "name") == [("MyOMS",)]
    assert rows(lookup_by_name(app, spark.createDataFrame([("MyCRM",)], "name string"), "name"), "id") == [(1,)]


def test_src_typing_turns_bad_times_into_null(spark):
    landed = spark.createDataFrame([("1", "a", "b", "c", "2018-09-01 00:00:00.0", "not a time")],
                                   "id string, name string, description string, version string, creation_time string, update_time string")
    typed = layers.build_src_master(landed, "app", "2018-09-03 00:00:00")
    assert typed.first()["creation_time"] == D1
    assert typed.first()["update_date"] is None
    assert typed.schema["id"].dataType == schemas.LONG


def test_a_stray_row_does_not_replace_an_older_day(spark, tmp_path):
    """Extracts are cut to the range that is built; other days and unreadable times go to quarantine."""
    wh = daily.Warehouse(spark, str(tmp_path), buckets=4)
    masters = {n: spark.createDataFrame(SEED1[n], schemas.MASTER[n]) for n in schemas.MASTER_TABLES}
    nothing = {n: spark.createDataFrame([], schemas.MASTER[n]) for n in schemas.MASTER_TABLES}

    def metrics(first, day, n):
        return [(first + i, "cpu.usage", "svr1001", 50, f"{day} 10:00:0{i}") for i in range(n)]

    kind = "id long, name string, hostname string, value long, timestamp string"
    one = spark.createDataFrame(metrics(0, "2018-09-02", 5), kind)
    daily.build_day(wh, {**masters, "metric": one}, "2018-09-01", "2018-09-03", "2018-09-03 01:00:00",
                    calendar=("2018-09-01 00:00:00", "2018-09-30 00:00:00"))
    stray = metrics(50, "2018-09-02", 1) + [(60, "cpu.usage", "svr1001", 1, "no time"), (61, "cpu.usage", "svr1001", 1, None)]
    two = spark.createDataFrame(metrics(10, "2018-09-03", 3) + stray, kind)
    late = spark.createDataFrame([(1, "MyCRM", "old", "0", D1, D1)], schemas.MASTER["app"])
    daily.build_day(wh, {**nothing, "app": late, "metric": two}, "2018-09-03", "2018-09-04", "2018-09-04 01:00:00")
    assert sorted(r[0] for r in rows(wh.range("src", "metric", "2018-09-01", "2018-09-30"), "id")) == [0, 1, 2, 3, 4, 10, 11, 12]
    assert sorted(r[0] for r in rows(wh.range("dwh", "metric", "2018-09-01", "2018-09-30"), "id")) == [0, 1, 2, 3, 4, 10, 11, 12]
    aside = spark.read.parquet(wh.path("quarantine", "metric/2018-09-03_2018-09-04"))
    assert [r[0] for r in rows(aside, "id")] == [50, 60, 61]
    assert spark.read.parquet(wh.path("quarantine", "app/2018-09-03_2018-09-04")).count() == 1
    assert rows(wh.current("dwh", "app"), "id", "name") == rows(masters["app"], "id", "name")
