"""Sliding windows of tables: what one task holds does not grow with the table."""

import random
from collections import defaultdict
from datetime import datetime, timezone

import pytest

from beaconry.streaming import windows as w
from tests.helpers import plan, rows

SIZE, SLIDE = 60, 20
T0 = 1_700_000_000


def readings(n: int = 400) -> list[tuple]:
    """Dense and sparse hosts over several blocks of time, some without name, value or time."""
    draw = random.Random(7)
    hosts, out = ["dense", "a", "b", "c", None], []
    for _ in range(n):
        host = draw.choice(hosts)
        at = T0 + draw.randrange(300 if host == "dense" else 6000)
        stamp = None if draw.random() < 0.05 else datetime.fromtimestamp(at, timezone.utc)
        out.append((host, draw.choice(["cpu", "mem"]), None if draw.random() < 0.2 else draw.randrange(100), stamp))
    return out


@pytest.fixture
def table(spark):
    return spark.createDataFrame(readings(), "hostname string, name string, value long, timestamp timestamp")


def expected(data) -> dict:
    held = defaultdict(list)
    for host, name, value, stamp in data:
        if stamp is not None:
            at = int(stamp.timestamp()) // SLIDE * SLIDE
            for end in range(at + SLIDE, at + SIZE + 1, SLIDE):
                held[host, name, end].append(value)
    means = {}
    for key, values in held.items():
        known = [v for v in values if v is not None]
        means[key] = sum(known) / len(known) if known else None
    return means


def windows(table, **options):
    return w.sliding_mean(table, size=SIZE, slide=SLIDE, by=["name"], **options)


@pytest.mark.parametrize("parts", [None, 1, 13])
def test_windows_equal_brute_force_whatever_the_parts(table, parts):
    got = rows(windows(table, parts=parts), "hostname", "name", "timestamp", "avg")
    want = expected(readings())
    assert len(got) == len(want)
    assert {r[:3]: r[3] for r in got} == want


def test_parts_grow_with_the_rows(spark, table, monkeypatch):
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert w.window_parts(table, SIZE, SLIDE) == shuffles
    monkeypatch.setattr(w, "WINDOWS_PER_TASK", 30)
    # 400 rows in three windows each
    assert w.window_parts(table, SIZE, SLIDE) == 40
    assert windows(table).rdd.getNumPartitions() == 40


def test_windows_are_not_held_in_a_table(table):
    """Rows are grouped into tiles, windows are not grouped: a task would hold all it has."""
    assert plan(windows(table)).count("HashAggregate") == 2


@pytest.mark.parametrize("limit", [None, 0])
def test_health_in_parts(spark, table, limit):
    thresholds = spark.createDataFrame(
        [(h, m, i, 40, 60) for i, h in enumerate(["dense", "a", "b"]) for m in ("cpu", "mem")],
        "hostname string, metric_name string, server_id long, amber_threshold int, red_threshold int")

    def health(**parts):
        rated = w.evaluate_metrics(windows(table, **parts), thresholds, limit, **parts)
        return w.server_health(w.known_states(rated), 40, **parts)

    want = rows(health())
    assert want and rows(health(parts=11)) == want
    assert health(parts=11).rdd.getNumPartitions() == 11
