"""Windows and health over many batches: as brute force has them, with no more kept than a row to come can meet."""

import random
from collections import defaultdict
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from beaconry import schemas
from beaconry.operators.skew import task_parts
from beaconry.streaming import carried, fanout, sinks, streams
from tests.helpers import rows
from tests.test_streaming import T0, Folder, masters, metric, run_fan_out  # noqa: F401  (masters is a fixture)

SIZE, SLIDE, DELAY = 60, 20, 45
# starts of the batches; every seventh row comes late, and some come again
START = [0, 130, 135, 150, 2000, 2030]


def instant(second: int) -> datetime:
    return datetime.fromtimestamp(T0 + second, timezone.utc)


def readings() -> list[list[tuple]]:
    draw, out, sent = random.Random(3), [], []
    for k, start in enumerate(START):
        batch = [(100 * k + i, f"svr{draw.randrange(3)}", draw.randrange(100), start + draw.randrange(90) - 200 * (i % 7 == 6))
                 for i in range(40)]
        batch += draw.sample(sent, min(len(sent), 8)) + batch[:3]
        sent += batch
        out.append(batch)
    return out


def brute_windows(batches):
    newest, held, values = None, set(), defaultdict(list)
    for batch in batches:
        touched = set()
        for i, host, value, t in batch:
            if (newest is not None and t <= newest - DELAY) or (i, t) in held:
                continue
            held.add((i, t))
            first = (T0 + t) // SLIDE * SLIDE + SLIDE
            for end in range(first, first + SIZE, SLIDE):
                values[host, end].append(value)
                touched.add((host, end))
        newest = max([t for *_, t in batch] + ([] if newest is None else [newest]))
        yield newest, sorted((h, e, sum(values[h, e]) / len(values[h, e])) for h, e in touched)


def test_updated_windows_equal_brute_force_and_old_rows_go(spark, tmp_path):
    folder, batches = str(tmp_path / "state"), readings()
    for n, (batch, (newest, want)) in enumerate(zip(batches, brute_windows(batches))):
        typed = spark.createDataFrame([(i, "cpu.usage", h, v, instant(t)) for i, h, v, t in batch], schemas.METRIC)
        # a batch that runs again gives the same
        for _ in range(2):
            got = fanout.updated_windows(typed, n, folder, DELAY, SIZE, SLIDE)
            assert [(h, e, round(a, 9)) for h, e, a in rows(got, "hostname", "timestamp", "avg")] == [(h, e, round(a, 9)) for h, e, a in want]
        for part, oldest in (("seen", "unix_timestamp(timestamp)"), ("tiles", f"tile + {SIZE}")):
            kept = spark.read.parquet(f"{folder}/{part}/batch_id={n}").agg(F.min(F.expr(oldest)).alias("t")).first().t
            assert kept > T0 + newest - DELAY
            assert len(list((tmp_path / "state" / part).glob("batch_id=*"))) <= 2
    assert want


def brute_health(batches, sources, delay, step):
    newest, last = None, {}
    for n, batch in enumerate(batches):
        touched = set()
        for server, t, source, severity in batch:
            tick = -(-(T0 + t) // step) * step
            if newest is None or tick >= T0 + newest - delay:
                last[server, tick, source] = severity
                touched.add((server, tick))
        newest = max([t for _, t, *_ in batch] + ([] if newest is None else [newest]))
        yield newest, sorted((s, t, max([last[s, t, x] for x in sources if (s, t, x) in last] + [0])) for s, t in touched)


def test_updated_health_equals_brute_force_and_old_ticks_go(spark, tmp_path):
    folder, draw, sources = str(tmp_path / "state"), random.Random(5), ["cpu", "alert"]
    batches = []
    for start in (0, 40, 45, 60, 900):
        ticks = {(draw.randrange(4), start + 5 * draw.randrange(12) - 300 * (i % 6 == 5), draw.choice([*sources, "other"])) for i in range(40)}
        batches.append([(*t, draw.randrange(3)) for t in sorted(ticks)])
    for n, (batch, (newest, want)) in enumerate(zip(batches, brute_health(batches, sources, 50, 5))):
        typed = spark.createDataFrame([(s, instant(t), x, v, n) for s, t, x, v in batch], fanout.HEALTH_INPUT)
        for _ in range(2):
            assert rows(fanout.updated_health(typed, n, folder, sources, 50, 5)) == want
        kept = spark.read.parquet(f"{folder}/ratings/batch_id={n}").agg(F.min("timestamp").alias("t")).first().t
        assert kept >= T0 + newest - 50
    assert want


def test_the_fan_out_keeps_nothing_in_executors(spark, masters, tmp_path):  # noqa: F811
    """A backlog leaves the rows of its last minute, and no query has state of Spark's."""
    folder, root = Folder(spark, tmp_path / "in"), str(tmp_path / "out")
    folder.add("cu", *[metric(i, 70, 30 * i) for i in range(200)])
    _, queries = run_fan_out(spark, folder, masters, root, offer=True)
    health = fanout.health_query(spark, root, ["cpu_usage", "mem_used"], available_now=True)
    health.awaitTermination()
    assert not any(p.stateOperators for q in [*queries, health] for p in q.recentProgress)
    assert spark.read.parquet(f"{root}/window_state/cpu_usage/seen").count() == 2
    states = streams.read_states(spark, root, ["cpu_usage"])
    assert states.count() == (199 * 30 + 60) // 5
    assert rows(fanout.read_health(spark, root), "timestamp", "severity") == rows(states, "timestamp", "severity")


@pytest.mark.parametrize("size, final", [(50, False), (60, True)])
def test_other_windows_are_kept_by_spark(spark, masters, tmp_path, size, final):  # noqa: F811
    folder, root = Folder(spark, tmp_path / "in"), str(tmp_path / "out")
    folder.add("cu", metric(1, 70, 0), metric(2, 95, 400))
    _, queries = run_fan_out(spark, folder, masters, root, size=size, slide=20, final=final)
    assert any(p.stateOperators for p in queries[0].recentProgress)
    ends = [r[0] - T0 for r in rows(streams.read_states(spark, root, ["cpu_usage"]), "timestamp")]
    # a slide that does not divide the size begins its windows on the slide
    assert [t for t in ends if t < 300] == ([20, 40, 60] if final else [10, 30, 50])


def test_a_costly_batch_is_computed_once(spark, tmp_path):
    path, schema = str(tmp_path / "sink"), schemas.struct(id=schemas.LONG, v=schemas.STR)
    ran = spark.sparkContext.accumulator(0)

    def counted(i, part):
        ran.add(1)
        return part

    def batch(*data):
        return spark.createDataFrame(spark.sparkContext.parallelize(data, 4).mapPartitionsWithIndex(counted), schema)

    sink = sinks.upsert_sink(path, schema.names, ["id"], costly=True)
    sink(batch((1, "a"), (2, "b"), (3, "c"), (4, "d")), 0)
    assert ran.value == 4
    sink(batch(), 1)
    assert not (tmp_path / "sink" / "delta" / "batch_id=1").exists()
    # a batch that runs again and is empty now replaces what it left
    sink(batch((5, "e")), 2)
    sink(batch(), 2)
    assert rows(sinks.read_upserts(spark, path, schema, ["id"])) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_carried_rows_are_those_of_the_batch_before(spark, tmp_path):
    folder, schema = str(tmp_path / "kept"), schemas.struct(id=schemas.LONG)
    for n in range(4):
        assert rows(carried.read_carried(spark, folder, n, schema)) == ([(n - 1,)] if n else [])
        for _ in range(2):
            carried.write_carried(spark.createDataFrame([(n,)], schema), folder, n)
    assert rows(carried.read_carried(spark, folder, 3, schema)) == [(2,)]


def test_rows_of_few_per_key_are_dealt_into_parts(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "sink"), schemas.struct(id=schemas.LONG, v=schemas.INT)
    sink = sinks.upsert_sink(path, schema.names, ["id"], every=3)
    monkeypatch.setattr(sinks, "ROWS_PER_TASK", 30)
    dealt = []
    monkeypatch.setattr(sinks, "task_parts", lambda *a: dealt.append(task_parts(*a)) or dealt[-1])
    for n in range(5):
        sink(spark.range(50 * n, 50 * n + 200).selectExpr("if(id % 50 = 3, null, id) AS id", f"CAST(id % 3 + {n} AS int) AS v"), n)
        # pending batches alone, then a base, then both
        want = rows(sinks.read_upserts(spark, path, schema, ["id"]))
        assert not dealt and rows(sinks.read_upserts(spark, path, schema, ["id"], few=True)) == want
        assert dealt in ([], [max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-200 * ((n % 3) + 1) // 30))])
        dealt.clear()
