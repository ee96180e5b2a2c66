"""Streams over several micro-batches: duplicates, late rows, restarts, lasting incident state."""

import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from beaconry import schemas
from beaconry.operators.aggregates import incident_registry, server_severity
from beaconry.operators.lookup import metric_thresholds
from beaconry.sources import messages as m
from beaconry.sources import polling
from beaconry.streaming import alerts as al
from beaconry.streaming import fanout, sinks, streams
from beaconry.streaming import windows as w
from tests.helpers import rows

T0 = int(datetime(2024, 1, 1).timestamp())


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """Every micro-batch opens each partition's state, so there are as few as show the point."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def masters(spark):
    server = spark.createDataFrame([(1, 1, "svr1", 4, 8, None, None), (2, 1, "svr2", 4, 8, None, None)], schemas.MASTER["server"])
    threshold = spark.createDataFrame([(1, "cpu.usage", 80, 90, None, None), (2, "cpu.usage", 50, 60, None, None)],
                                      schemas.MASTER["metric_threshold"])
    index = spark.createDataFrame([(1, "disk", 2, None, None), (2, "net", 1, None, None)], schemas.ALERT_INDEX)
    return server, threshold, index


class Folder:
    """A folder of message files; each file is one micro-batch."""

    def __init__(self, spark, path):
        self.spark, self.path, self.n = spark, path, 0
        path.mkdir()

    def add(self, prefix, *bodies):
        values = [(f"{prefix}|1", b if isinstance(b, str) else json.dumps(b)) for b in bodies]
        self.n += 1
        staged = self.path.parent / f"{self.path.name}-staged-{self.n}"
        self.spark.createDataFrame(values, schemas.TRUNK).coalesce(1).write.parquet(str(staged))
        next(staged.glob("*.parquet")).rename(self.path / f"{self.n:04}.parquet")

    def trunk(self):
        return m.read_trunk_files(self.spark, str(self.path), max_files=1)


def metric(i, value, second, host="svr1", name="cpu.usage"):
    return {"id": i, "name": name, "hostname": host, "value": value, "timestamp": T0 + second}


def alert(i, status, second, host="svr1", message="disk"):
    return {"id": i, "message": message, "hostname": host, "status": status, "timestamp": T0 + second}


def run_metrics(folder, masters, root):
    server, threshold, _ = masters
    queries = streams.metric_stream(folder.trunk(), server, threshold, "cpu_usage", root, available_now=True)
    for q in queries:
        q.awaitTermination()
    return queries


def test_metric_stream(spark, masters, tmp_path):
    folder, root = Folder(spark, tmp_path / "in"), str(tmp_path / "out")
    first = [metric(1, 70, 2), metric(2, 100, 3), metric(3, 55, 4, "svr2")]
    folder.add("cu", *first, "{not json", {"id": 9, "name": "cpu.usage"}, metric(8, 5, 4, "nobody"))
    folder.add("mu", metric(50, 1, 1))
    folder.add("cu", metric(2, 100, 3), metric(4, 94, 30))
    run_metrics(folder, masters, root)

    raw = sinks.read_upserts(spark, f"{root}/cpu_usage", schemas.METRIC, ["id"])
    assert [r[0] for r in rows(raw, "id")] == [1, 2, 3, 4, 8]
    bad = spark.read.parquet(f"{root}/quarantine_cpu_usage/delta")
    assert sorted(r["raw"] for r in bad.collect()) == sorted(["{not json", json.dumps({"id": 9, "name": "cpu.usage"})])

    states = {(s, t): v for s, t, v in rows(streams.read_states(spark, root, ["cpu_usage"]), "server_id", "timestamp", "severity")}
    # until second 30 the window holds 70 and 100 (85: amber), then also 94 (88: amber), then only 94 (red)
    assert states[1, T0 + 5] == 1 and states[1, T0 + 60] == 1
    assert states[1, T0 + 65] == 2 and states[1, T0 + 90] == 2
    assert (1, T0 + 95) not in states
    assert states[2, T0 + 5] == 1

    typed = spark.createDataFrame([(*r.values(),) for r in [*first, metric(4, 94, 30)]], schemas.METRIC_MESSAGE)
    batch = w.sliding_mean(typed.withColumn("timestamp", F.timestamp_seconds("timestamp")))
    rated = w.known_states(w.evaluate_metric(batch, metric_thresholds(*masters[:2], "cpu_usage"), "cpu_usage"))
    assert {(s, t): v for s, t, v in rows(rated, "server_id", "timestamp", "severity")} == states


def test_late_rows_are_dropped_and_restart_continues(spark, masters, tmp_path):
    folder, root = Folder(spark, tmp_path / "in"), str(tmp_path / "out")
    folder.add("cu", metric(1, 70, 0))
    folder.add("cu", metric(2, 70, 1000))
    run_metrics(folder, masters, root)
    # the watermark is now 60 seconds behind second 1000
    folder.add("cu", metric(3, 100, 500), metric(4, 100, 1001))
    _, evaluate = run_metrics(folder, masters, root)
    assert w.dropped_by_watermark(evaluate) > 0
    states = {t - T0: v for _, t, v in rows(streams.read_states(spark, root, ["cpu_usage"]), "server_id", "timestamp", "severity")}
    assert not any(500 < t <= 560 for t in states)
    assert states[1005] == 1  # (70 + 100) / 2, so the state from before the restart was kept
    raw = sinks.read_upserts(spark, f"{root}/cpu_usage", schemas.METRIC, ["id"])
    assert raw.count() == 4


def run_alerts(folder, masters, root, **options):
    server, _, index = masters
    for q in streams.alert_stream(folder.trunk(), server, index, root, available_now=True, **options):
        q.awaitTermination()


def current(spark, root):
    states = streams.read_states(spark, root, ["alert"])
    newest = states.groupBy("server_id").agg(F.max_by("severity", "timestamp").alias("severity"))
    return dict(rows(newest, "server_id", "severity"))


def test_alert_stream_keeps_state_over_batches(spark, masters, tmp_path):
    folder, root = Folder(spark, tmp_path / "in"), str(tmp_path / "out")
    folder.add("al", alert(1, "OPEN", 0), alert(2, "OPEN", 0, "svr2", "net"))
    folder.add("al", alert(3, "CLOSED", 10), alert(4, "OPEN", 20, "svr1", "net"))
    run_alerts(folder, masters, root, ttl=None)
    assert current(spark, root) == {1: 2, 2: 1}
    # days later the first incident is closed; no watermark may lose that
    folder.add("al", alert(5, "OPEN", 400_000, "svr2"), alert(6, "CLOSED", 0))
    run_alerts(folder, masters, root, ttl=None)
    assert current(spark, root) == {1: 1, 2: 2}
    registry = al.read_registry(spark, f"{root}/registry")
    assert (1, 1, T0, True, True) in rows(registry)
    assert (1, 1, T0 + 10, False, True) in rows(registry)


def test_alert_stream_equals_one_batch_in_any_order(spark, masters, tmp_path):
    server, _, index = masters
    all_alerts = [alert(i, "OPEN" if i % 3 else "CLOSED", i % 4, f"svr{i % 2 + 1}", ("disk", "net")[i % 5 % 2]) for i in range(24)]
    typed = spark.createDataFrame([(*a.values(),) for a in all_alerts], schemas.ALERT_MESSAGE)
    identified = al.identify(typed.withColumn("timestamp", F.timestamp_seconds("timestamp")), server.withColumnRenamed("id", "server_id"), index)
    expected = dict(rows(server_severity(incident_registry(identified), index)))
    for k, order in enumerate((all_alerts, all_alerts[::-1])):
        folder, root = Folder(spark, tmp_path / f"in{k}"), str(tmp_path / f"out{k}")
        for part in (order[:7], order[7:15], order[15:]):
            folder.add("al", *part)
        run_alerts(folder, masters, root, ttl=None)
        registry = al.read_registry(spark, f"{root}/registry")
        assert dict(rows(server_severity(registry, index))) == expected


def test_incidents_expire(spark, masters, tmp_path):
    folder, root = Folder(spark, tmp_path / "in"), str(tmp_path / "out")
    folder.add("al", alert(1, "OPEN", 0), alert(2, "OPEN", 0, "svr2", "net"))
    folder.add("al", alert(3, "OPEN", 70, "svr1", "net"))
    run_alerts(folder, masters, root)
    # the disk incident is older than 60 seconds at second 70, so only the net incident counts
    # and the net incident of the other server is gone too, though nothing came for it
    assert current(spark, root) == {1: 1, 2: 0}
    registry = al.read_registry(spark, f"{root}/registry")
    assert rows(registry, "server_id", "incident_ts") == [(1, T0 + 70)]
    # an incident that arrives too old counts for nothing, and a server left without any is in order
    folder.add("al", alert(4, "OPEN", 1))
    folder.add("al", alert(5, "OPEN", 2, "svr2"))
    run_alerts(folder, masters, root, clock=lambda: T0 + 100)
    assert current(spark, root) == {1: 1, 2: 0}


def test_an_expired_incident_clears_its_server_when_time_moves_elsewhere(spark, masters, tmp_path):
    folder, root = Folder(spark, tmp_path / "in"), str(tmp_path / "out")
    folder.add("al", alert(1, "OPEN", 0))
    folder.add("al", alert(2, "OPEN", 59, "svr2", "net"))
    run_alerts(folder, masters, root)
    assert current(spark, root) == {1: 2, 2: 1}
    folder.add("al", alert(3, "OPEN", 60, "svr2", "net"))
    run_alerts(folder, masters, root)
    assert current(spark, root) == {1: 0, 2: 1}
    states = {(r.server_id, r.timestamp - T0): r.severity for r in streams.read_states(spark, root, ["alert"]).collect()}
    assert states[1, 5] == 2 and states[1, 65] == 0
    # a batch writes what it changed: one incident and one state in the last one, and the expiry
    assert spark.read.parquet(f"{root}/registry/delta/batch_id=0").count() == 1


def test_registry_does_not_depend_on_the_batches(spark, masters, tmp_path):
    alerts = [alert(i, "OPEN" if i % 3 else "CLOSED", i * 7 % 200, f"svr{i % 2 + 1}", ("disk", "net")[i % 5 % 2]) for i in range(60)]
    found = []
    for k, size in enumerate((60, 13, 1)):
        folder, root = Folder(spark, tmp_path / f"in{k}"), str(tmp_path / f"out{k}")
        for at in range(0, 60 if size > 1 else 5, size):
            folder.add("al", *alerts[at:at + size])
        if size == 1:
            folder.add("al", *alerts[5:])
        run_alerts(folder, masters, root, ttl=60)
        found.append(rows(al.read_registry(spark, f"{root}/registry")))
    assert found[0] == found[1] == found[2] and found[0]


def test_an_alert_from_the_future_expires_nothing(spark, masters, tmp_path):
    folder, root = Folder(spark, tmp_path / "in"), str(tmp_path / "out")
    folder.add("al", alert(1, "OPEN", 0))
    folder.add("al", alert(2, "OPEN", 4_000_000_000 - T0, "svr2", "net"))
    run_alerts(folder, masters, root, clock=lambda: T0 + 30)
    assert current(spark, root) == {1: 2, 2: 1}
    assert [r[0] for r in rows(al.read_registry(spark, f"{root}/registry"), "server_id")] == [1, 2]


def test_masters_are_read_for_every_batch(spark, masters, tmp_path):
    """A host and a threshold that change between batches count from the next batch on; unknown hosts are set aside."""
    folder, root = Folder(spark, tmp_path / "in"), str(tmp_path / "out")
    server, threshold, _ = masters
    now = {"server": server, "threshold": threshold}

    def run():
        queries = streams.metric_stream(folder.trunk(), lambda: now["server"], lambda: now["threshold"], "cpu_usage", root, available_now=True)
        for q in queries:
            q.awaitTermination()

    kind = schemas.struct(hostname=schemas.STR, timestamp=schemas.LONG, src_type=schemas.STR)
    folder.add("cu", metric(1, 85, 2), metric(2, 85, 2, "new"))
    run()
    unknown = sinks.read_upserts(spark, f"{root}/quarantine_cpu_usage_unknown", kind, streams.UNKNOWN_COLUMNS)
    assert {r[0] for r in rows(unknown, "hostname")} == {"new"} and unknown.count() == 12
    now["server"] = server.unionByName(spark.createDataFrame([(3, 1, "new", 4, 8, None, None)], server.schema))
    now["threshold"] = spark.createDataFrame([(1, "cpu.usage", 10, 20, None, None), (3, "cpu.usage", 10, 99, None, None)], threshold.schema)
    folder.add("cu", metric(3, 85, 2), metric(4, 85, 2, "new"))
    run()
    states = rows(streams.read_states(spark, root, ["cpu_usage"]), "server_id", "severity")
    assert set(states) == {(1, 2), (3, 1)}


def test_unknown_alerts_are_quarantined(spark, masters, tmp_path):
    folder, root = Folder(spark, tmp_path / "in"), str(tmp_path / "out")
    folder.add("al", alert(1, "OPEN", 0, "nobody"), alert(2, "OPEN", 0, "svr1", "strange"), alert(3, "LOST", 0), alert(4, "OPEN", 0))
    run_alerts(folder, masters, root)
    assert current(spark, root) == {1: 2}
    assert [r[0] for r in rows(spark.read.parquet(f"{root}/quarantine_alert_unknown/delta"), "id")] == [1, 2]
    assert spark.read.parquet(f"{root}/quarantine_alert/delta").count() == 1


def test_upserts_keep_the_last_batch_and_compact(spark, tmp_path):
    path = str(tmp_path / "sink")
    sink = sinks.upsert_sink(path, ["id", "v"])
    schema = schemas.struct(id=schemas.LONG, v=schemas.STR)
    write = lambda batch_id, *data: sink(spark.createDataFrame(list(data), schema), batch_id)
    write(0, (1, "a"), (2, "a"))
    write(1, (2, "b"))
    write(1, (2, "b"))  # the same batch again after a failure
    assert rows(sinks.read_upserts(spark, path, schema, ["id"])) == [(1, "a"), (2, "b")]
    assert rows(sinks.compact_upserts(spark, path, schema, ["id"])) == [(1, "a"), (2, "b")]
    write(2, (1, "c"), (3, "c"))
    assert rows(sinks.read_upserts(spark, path, schema, ["id"])) == [(1, "c"), (2, "b"), (3, "c")]
    sinks.compact_upserts(spark, path, schema, ["id"])
    assert rows(sinks.read_upserts(spark, path, schema, ["id"])) == [(1, "c"), (2, "b"), (3, "c")]
    assert not any((tmp_path / "sink" / "delta").iterdir())


def test_unfinished_batches_are_left_alone(spark, tmp_path):
    path = str(tmp_path / "sink")
    schema = schemas.struct(id=schemas.LONG, v=schemas.STR)
    sink = sinks.upsert_sink(path, ["id", "v"], ["id"])
    sink(spark.createDataFrame([(1, "a")], schema), 0)
    half = tmp_path / "sink" / "delta" / "batch_id=1" / "_temporary"
    half.mkdir(parents=True)
    (half / "part").write_text("being written")
    assert rows(sinks.compact_upserts(spark, path, schema, ["id"])) == [(1, "a")]
    assert (half / "part").exists()
    assert rows(sinks.read_upserts(spark, path, schema, ["id"])) == [(1, "a")]


def test_sinks_fold_their_batches(spark, tmp_path):
    path = str(tmp_path / "sink")
    schema = schemas.struct(id=schemas.LONG, v=schemas.STR)
    sink = sinks.upsert_sink(path, ["id", "v"], ["id"], every=10)
    most = 0
    for n in range(35):
        sink(spark.createDataFrame([(n % 4, f"v{n:02}")] if n % 7 else [], schema), n)
        most = max(most, len(list((tmp_path / "sink" / "delta").glob("batch_id=*"))) if (tmp_path / "sink" / "delta").exists() else 0)
    assert most <= 10
    assert rows(sinks.read_upserts(spark, path, schema, ["id"])) == [(0, "v32"), (1, "v33"), (2, "v34"), (3, "v31")]


def size_of(folder):
    return sum(f.stat().st_size for f in folder.rglob("*.parquet"))


def test_folds_rewrite_only_the_buckets_they_touch(spark, tmp_path):
    """A thousand batches, most of them to a few keys: bytes written per fold follow the touched buckets."""
    path, folder = str(tmp_path / "sink"), tmp_path / "sink"
    schema = schemas.struct(id=schemas.LONG, v=schemas.STR)
    filled = spark.range(4000).select("id", F.concat(F.lit("first"), F.sha2(F.col("id").cast("string"), 256)).alias("v"))
    sinks.upsert_sink(path, ["id", "v"], ["id"], every=1, buckets=16)(filled, 0)
    whole = size_of(folder / "base-16")
    # the batches between two folds are written at once, in the layout the sink gives them
    want = {r.id: r.v for r in filled.collect()}
    for first in range(1, 1000, 250):
        keys = [first % 7, 11]
        batches = spark.range(first, first + 250).select(
            F.element_at(F.array(*map(F.lit, keys)), (F.col("id") % 2 + 1).cast("int")).cast("long").alias("key"),
            F.concat(F.lit("v"), "id").alias("v"), F.col("id").alias(sinks.BATCH))
        staged = tmp_path / f"staged-{first}"
        batches.select(F.col("key").alias("id"), "v", sinks.BATCH).repartition(sinks.BATCH).write.partitionBy(sinks.BATCH).parquet(str(staged))
        for batch in staged.glob("batch_id=*"):
            (batch / "_SUCCESS").touch()
            (folder / "delta").mkdir(exist_ok=True)
            batch.rename(folder / "delta" / batch.name)
        for r in batches.orderBy(sinks.BATCH).collect():
            want[r.key] = r.v
        touched = sinks.fold_upserts(spark, path, schema, ["id"])
        assert len(touched) <= 2
        newest = max(folder.glob("base-16/fold=*"), key=lambda p: int(p.name[5:]))
        assert sorted(int(b.name[7:]) for b in newest.glob("bucket=*")) == touched
        assert size_of(newest) < whole * len(touched) / 16 * 2
    table = sinks.read_upserts(spark, path, schema, ["id"])
    assert {r.id: r.v for r in table.collect()} == want
    # superseded buckets go, but for the one before the current
    assert all(len(list(folder.glob(f"base-16/fold=*/bucket={b}"))) <= 2 for b in range(16))


def test_keyed_reads_open_one_bucket(spark, tmp_path):
    path, folder = str(tmp_path / "sink"), tmp_path / "sink"
    schema = schemas.struct(id=schemas.LONG, v=schemas.STR)
    sink = sinks.upsert_sink(path, ["id", "v"], ["id"], every=2, buckets=8)
    for n in range(3):
        sink(spark.range(200).select("id", F.lit(f"v{n}").alias("v")), n)
    wanted = spark.createDataFrame([(7,), (7,), (1000,), (None,)], "id int")
    found = sinks.read_upserts(spark, path, schema, ["id"], wanted.filter("id = 7"))
    assert rows(found) == [(7, "v2")]
    assert len({f.split("bucket=")[1].split("/")[0] for f in found.inputFiles() if "bucket=" in f}) == 1
    assert rows(sinks.read_upserts(spark, path, schema, ["id"], wanted)) == [(7, "v2")]
    assert len(list((folder / "base-8").glob("fold=*/bucket=*"))) == 8


def test_a_folded_batch_that_runs_again_counts_as_it_is_now(spark, tmp_path):
    schema = schemas.struct(id=schemas.LONG, v=schemas.STR)
    for keys in (["id"], []):
        path = str(tmp_path / f"sink{len(keys)}")
        sink = sinks.upsert_sink(path, ["id", "v"], keys, every=2)
        for n, data in [(0, [(1, "a"), (2, "a")]), (1, [(2, "b"), (None, "b")]), (2, [(3, "c")]), (1, [(2, "B"), (None, "b")])]:
            sink(spark.createDataFrame(data, schema), n)
        want = [(1, "a"), (2, "B"), (3, "c"), (None, "b")] if keys else [(1, "a"), (2, "a"), (2, "B"), (3, "c"), (None, "b")]
        assert rows(sinks.read_upserts(spark, path, schema, keys)) == sorted(want, key=repr)
        assert rows(sinks.compact_upserts(spark, path, schema, keys)) == sorted(want, key=repr)
        assert rows(sinks.read_upserts(spark, path, schema, keys)) == sorted(want, key=repr)


def test_keyless_sinks_count_a_repeated_batch_once(spark, tmp_path):
    path = str(tmp_path / "sink")
    schema = schemas.struct(raw=schemas.STR)
    sink = sinks.upsert_sink(path, ["raw"], every=2)
    for n in (0, 1, 1, 2):
        sink(spark.createDataFrame([(f"m{n}",), ("x",)], schema), n)
    assert [r[0] for r in rows(sinks.read_upserts(spark, path, schema))] == ["m0", "m1", "m2", "x", "x", "x"]


def test_shared_state_key(spark, tmp_path):
    root = str(tmp_path)
    for source, level in (("cpu_usage", 2), ("alert", 0)):
        sink = sinks.upsert_sink(f"{root}/server_state_{source}", sinks.STATE_SINK_COLUMNS)
        sink(spark.createDataFrame([(1, 100, source, level)], schemas.SERVER_STATE), 0)
    both = streams.read_states(spark, root, ["cpu_usage", "alert"])
    assert rows(both, "src_type", "severity") == [("alert", 0), ("cpu_usage", 2)]
    shared = streams.read_states(spark, root, ["cpu_usage", "alert"], shared_key=True)
    assert rows(shared, "src_type", "severity") == [("alert", 0)]
    assert rows(w.server_health(both), "timestamp", "severity") == [(100, 2)]


def test_duplicates_in_later_batches_are_removed(spark, tmp_path):
    folder, root = Folder(spark, tmp_path / "in"), tmp_path / "out"
    folder.add("cu", metric(1, 10, 0), metric(1, 10, 0))
    folder.add("cu", metric(1, 10, 0), metric(2, 10, 5))
    rows_ = m.accepted(m.decode_metric(m.route(folder.trunk(), "cu")))
    unique = w.dedup_stream(w.with_event_time(rows_, "timestamp", "60 seconds"), ["id"], "timestamp")
    sinks.start_update_query(unique, sinks.upsert_sink(f"{root}/s", ["id"]), f"{root}/c", available_now=True).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(f"{root}/s/delta").collect()) == [1, 2]


def registry_by_aggregation(spark, folder, masters, root, watermark):
    server, _, index = masters
    rows_ = m.accepted(m.decode_alert(m.route(folder.trunk(), "al")))
    updates = al.registry_updates(rows_, server.withColumnRenamed("id", "server_id"), index, watermark)
    sink = sinks.upsert_sink(f"{root}/r", al.REGISTRY.names)
    sinks.start_update_query(updates, sink, f"{root}/c", available_now=True).awaitTermination()
    return rows(sinks.read_upserts(spark, f"{root}/r", al.REGISTRY, al.REGISTRY_KEYS))


def test_both_forms_of_the_registry_agree_on_late_and_unordered_alerts(spark, masters, tmp_path):
    folder = Folder(spark, tmp_path / "in")
    folder.add("al", alert(1, "CLOSED", 50), alert(2, "OPEN", 0))
    folder.add("al", alert(3, "OPEN", 400_000), alert(4, "OPEN", 50))
    folder.add("al", alert(5, "OPEN", 500_000, "svr2", "net"))
    folder.add("al", alert(6, "CLOSED", 0))  # more than five days late
    root = str(tmp_path / "table")
    run_alerts(folder, masters, root, ttl=None)
    by_table = rows(al.read_registry(spark, f"{root}/registry"))
    assert registry_by_aggregation(spark, folder, masters, str(tmp_path / "state"), None) == by_table
    assert (1, 1, T0, True, True) in by_table and (1, 1, T0 + 50, True, True) in by_table
    # with a day's watermark the late CLOSED is lost
    bounded = registry_by_aggregation(spark, folder, masters, str(tmp_path / "bounded"), w.ALERT_WATERMARK)
    assert (1, 1, T0, True, False) in bounded and (1, 1, T0 + 50, True, True) in bounded


KINDS = {"cpu_usage": "cu", "mem_used": "mu"}


def run_fan_out(spark, folder, masters, root, **options):
    server, threshold, _ = masters
    read = fanout.fan_out(folder.trunk(), root, KINDS, available_now=True)
    read.awaitTermination()
    queries = [fanout.window_query(spark, root, k, server, threshold, available_now=True, **options) for k in KINDS]
    for q in queries:
        q.awaitTermination()
    return read, queries


def test_fan_out_reads_the_trunk_once_and_accounts_for_every_row(spark, masters, tmp_path):
    folder, root = Folder(spark, tmp_path / "in"), str(tmp_path / "out")
    folder.add("cu", metric(1, 70, 2), metric(2, 100, 3), "{not json", metric(7, 5, 4, "nobody"))
    folder.add("mu", metric(50, 1, 1, name="mem.used"))
    folder.add("cu", metric(3, 10, 1000), metric(2, 100, 3))
    read, queries = run_fan_out(spark, folder, masters, root)
    assert sum(p.numInputRows for p in read.recentProgress) == 7
    # the metrics' watermark is now at second 940, and that of the other metric at second -59
    folder.add("cu", metric(4, 100, 939), metric(5, 100, 940), metric(8, 100, 941), metric(6, 20, 1001))
    folder.add("mu", metric(51, 1, 2, name="mem.used"))
    folder.add("ot", metric(99, 1, 2, name="other"))
    read, queries = run_fan_out(spark, folder, masters, root)
    late = sinks.read_upserts(spark, f"{root}/late", fanout.LATE)
    assert rows(late, "id", "kind", "watermark") == [(4, "cpu_usage", T0 + 940), (5, "cpu_usage", T0 + 940)]
    # what is not late goes to the windows, whose own watermark drops nothing more
    fed = [r.id for k in KINDS for r in spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/window_input/{k}").collect()]
    assert sorted(fed + [r.id for r in late.collect()]) == [1, 2, 2, 3, 4, 5, 6, 7, 8, 50, 51]
    assert [w.dropped_by_watermark(q) for q in queries] == [0, 0]
    raw = sinks.read_upserts(spark, f"{root}/cpu_usage", schemas.METRIC, ["id"])
    assert [r[0] for r in rows(raw, "id")] == [1, 2, 3, 4, 5, 6, 7, 8]
    assert rows(sinks.read_upserts(spark, f"{root}/quarantine", schemas.struct(raw=schemas.STR))) == [("{not json",)]


def test_a_fan_out_batch_that_runs_again_splits_alike(spark, masters, tmp_path):
    """The batch's watermark is that of the batches before it, also when its own record is there already."""
    folder, root = Folder(spark, tmp_path / "in"), str(tmp_path / "out")
    folder.add("cu", metric(1, 70, 1000))
    folder.add("cu", metric(2, 70, 100), metric(3, 70, 9000))
    run_fan_out(spark, folder, masters, root)
    first = rows(sinks.read_upserts(spark, f"{root}/late", fanout.LATE), "id", "watermark")
    assert first == [(2, T0 + 940)]
    # as after a crash: the last batch is not committed and runs again
    (tmp_path / "out" / "checkpoints" / "fan_out" / "commits" / "1").unlink()
    for crc in (tmp_path / "out" / "checkpoints" / "fan_out" / "commits").glob(".1*"):
        crc.unlink()
    run_fan_out(spark, folder, masters, root)
    assert rows(sinks.read_upserts(spark, f"{root}/late", fanout.LATE), "id", "watermark") == first


def test_final_windows_equal_the_table_and_keep_a_row_in_one_state_entry(spark, masters, tmp_path):
    server, threshold, _ = masters
    # now and then a few rows close together, else one a minute
    messages = [metric(i, (i * 37) % 120, i * 61 - i % 3 * 59, f"svr{i // 3 % 2 + 1}") for i in range(150)]
    newest = max(r["timestamp"] for r in messages)
    typed = spark.createDataFrame([(*r.values(),) for r in messages], schemas.METRIC_MESSAGE)
    table = w.sliding_mean(typed.withColumn("timestamp", F.timestamp_seconds("timestamp")))
    rated = w.known_states(w.evaluate_metric(table, metric_thresholds(server, threshold, "cpu_usage"), "cpu_usage"))
    want = [r for r in rows(rated, "server_id", "timestamp", "severity") if r[1] <= newest - 60]
    updated = {}
    for final in (True, False):
        folder, root = Folder(spark, tmp_path / f"in{final}"), str(tmp_path / f"out{final}")
        for at in range(0, 150, 50):
            folder.add("cu", *messages[at:at + 50])
        queries = streams.metric_stream(folder.trunk(), server, threshold, "cpu_usage", root, available_now=True, final=final)
        for q in queries:
            q.awaitTermination()
        states = rows(streams.read_states(spark, root, ["cpu_usage"]), "server_id", "timestamp", "severity")
        assert (states == want) if final else (set(states) >= set(want))
        # state entries that the rows of a batch touch in the aggregation that follows the removal of duplicates
        means = [p.stateOperators[-2 if final else 0] for p in queries[1].recentProgress if p.numInputRows]
        updated[final] = sum(op.numRowsUpdated for op in means)
    assert updated[True] * 6 <= updated[False] and len(want) > 500


def test_health_takes_the_last_rating_of_each_source(spark, tmp_path):
    root = str(tmp_path)

    def offer(source, batch, *states):
        fanout.offer_states(spark.createDataFrame([(s, T0 + t, source, v) for s, t, v in states], schemas.SERVER_STATE), root, source, batch)
        fanout.health_query(spark, root, ["cpu_usage", "alert"], available_now=True).awaitTermination()

    offer("cpu_usage", 0, (1, 5, 2), (2, 5, 0))
    offer("alert", 0, (1, 5, 1), (2, 3, 1))
    assert rows(fanout.read_health(spark, root)) == [(1, T0 + 5, 2), (2, T0 + 5, 1)]
    offer("cpu_usage", 1, (1, 5, 0))
    assert rows(fanout.read_health(spark, root)) == [(1, T0 + 5, 1), (2, T0 + 5, 1)]
    states = spark.createDataFrame([(1, T0 + 5, "cpu_usage", 0), (1, T0 + 5, "alert", 1), (2, T0 + 5, "cpu_usage", 0), (2, T0 + 3, "alert", 1)],
                                   schemas.SERVER_STATE)
    assert rows(w.server_health(states)) == rows(fanout.read_health(spark, root))


POLLED = schemas.struct(id=schemas.LONG, wave_offset=schemas.INT, read_tick=schemas.LONG)


def poll_to(spark, table, root, until, sink=None):
    sink = sink or sinks.upsert_sink(f"{root}/rows", POLLED.names)
    return polling.poll(spark, table, "timestamp", sink, f"{root}/checkpoint", T0, until=until, offsets=(0, 10), available_now=True)


def test_a_poll_goes_on_where_it_stopped(spark, tmp_path):
    """Stopped between ticks, late, or in the midst of a batch: every row once per wave, at its nominal tick."""
    root = str(tmp_path)
    table = spark.createDataFrame([(i, datetime.fromtimestamp(T0 + i)) for i in range(1, 100)], "id long, timestamp timestamp")
    want = sorted((i, o, -(-(T0 + i + o) // 5) * 5) for i in range(1, 100) for o in (0, 10))

    def seen():
        return sorted(rows(sinks.read_upserts(spark, f"{root}/rows", POLLED)))

    for until in (T0 + 3, T0 + 22, T0 + 22, T0 + 57):
        poll_to(spark, table, root, until).awaitTermination()
        assert seen() == [r for r in want if r[2] <= T0 + (until - T0) // 5 * 5]

    class Killed(Exception):
        pass

    def killed(batch, batch_id):
        sinks.upsert_sink(f"{root}/rows", POLLED.names)(batch, batch_id)
        raise Killed

    with pytest.raises(Exception, match="Killed"):
        poll_to(spark, table, root, T0 + 80, killed).awaitTermination()
    # the batch was written but not committed: it runs again over its own ticks, then the later ones follow
    poll_to(spark, table, root, T0 + 200).awaitTermination()
    poll_to(spark, table, root, T0 + 200).awaitTermination()
    assert seen() == want
    assert len(list(Path(f"{root}/checkpoint/commits").glob("[0-9]*"))) >= 4


def test_a_poll_reads_the_table_of_the_moment_in_one_range(spark, tmp_path):
    from tests.helpers import plan

    path = str(tmp_path / "table")
    spark.createDataFrame([(1, datetime.fromtimestamp(T0 + 1))], "id long, timestamp timestamp").write.parquet(path)
    poll_to(spark, lambda: spark.read.parquet(path), str(tmp_path), T0 + 10).awaitTermination()
    spark.createDataFrame([(2, datetime.fromtimestamp(T0 + 12))], "id long, timestamp timestamp").write.mode("append").parquet(path)
    poll_to(spark, lambda: spark.read.parquet(path), str(tmp_path), T0 + 15).awaitTermination()
    assert rows(sinks.read_upserts(spark, f"{tmp_path}/rows", POLLED)) == [(1, 0, T0 + 5), (1, 10, T0 + 15), (2, 0, T0 + 15)]
    read = plan(polling.wave_rows(spark.read.parquet(path), "timestamp", T0, T0 + 100, 5, 0))
    assert "GreaterThan(timestamp" in read and "LessThanOrEqual(timestamp" in read
