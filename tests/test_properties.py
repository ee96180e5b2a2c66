"""Operators against brute force on random small inputs."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from beaconry import schemas
from beaconry.operators import aggregates as agg
from beaconry.operators import scd2
from beaconry.operators.joins import within_range
from beaconry.operators.merge import latest_per_key, merge_latest
from beaconry.operators.numbering import number_rows
from beaconry.plans import dimensions
from beaconry.session import materialize
from beaconry.sources.extract import multi_wave_extract
from beaconry.streaming.windows import dedup_stream, sliding_mean
from tests.helpers import rows

START = datetime(2024, 1, 1)
CHANGES = "id long, color string, update_date string, tie long"


def some_changes(seed: int, n: int = 120):
    """Changes of a few keys, one of which has a third of all rows."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        key = 0 if r.random() < 1 / 3 else r.randrange(1, 12)
        day = (START + timedelta(days=r.randrange(20))).strftime("%Y-%m-%d")
        out.append((key, r.choice("rgb"), day, i))
    return out


def expected_versions(changes):
    """Versions per key: last change of a day, repeats dropped, each ending where the next begins."""
    last = {}
    for key, color, day, tie in sorted(changes, key=lambda c: c[3]):
        last[key, day] = color
    by_key = defaultdict(list)
    for (key, day), color in sorted(last.items()):
        if not by_key[key] or by_key[key][-1][1] != color:
            by_key[key].append((day, color))
    out = set()
    for key, versions in by_key.items():
        for i, (day, color) in enumerate(versions):
            end = datetime.fromisoformat(versions[i + 1][0]) if i + 1 < len(versions) else None
            out.add((key, color, datetime.fromisoformat(day), end, end is None))
    return out


VERSION = ("id", "color", "valid_from", "valid_to", "eff_flag")


@pytest.mark.parametrize("seed", range(3))
def test_history_equals_brute_force(spark, seed):
    changes = some_changes(seed)
    dim = scd2.scd2_from_history(spark.createDataFrame(changes, CHANGES), ["id"], latest_by=["tie"])
    assert set(rows(dim, *VERSION)) == expected_versions(changes)
    assert sorted(r[0] for r in rows(dim, "dwid")) == list(range(1, dim.count() + 1))


@pytest.mark.parametrize("seed", range(3))
def test_increments_in_date_order_equal_history(spark, seed):
    changes = some_changes(seed)
    dim = spark.createDataFrame([], "dwid long, id long, color string, valid_from timestamp, valid_to timestamp, eff_flag boolean")
    for low, high in (("2024-01-01", "2024-01-08"), ("2024-01-08", "2024-01-15"), ("2024-01-15", "2024-02-01")):
        part = [c for c in changes if low <= c[2] < high]
        dim = scd2.scd2_apply(dim, spark.createDataFrame(part, CHANGES), ["id"], latest_by=["tie"])
    assert set(rows(dim, *VERSION)) == expected_versions(changes)
    assert sorted(r[0] for r in rows(dim, "dwid")) == list(range(1, dim.count() + 1))


COLORS = schemas.struct(dwid=schemas.LONG, id=schemas.LONG, color=schemas.STR, valid_from=schemas.TS, valid_to=schemas.TS,
                        eff_flag=schemas.BOOL)


@pytest.mark.parametrize("seed, order", [(0, (0, 1, 2, 3)), (1, (0, 3, 1, 2)), (2, (2, 2, 0, 3))])
def test_stored_dimensions_equal_whole_ones(spark, tmp_path, seed, order):
    """Increments of whole years, also years late and repeated: same rows, and only reached partitions are written."""
    path, root = str(tmp_path / "dim"), str(tmp_path / "dim" / "base-4")
    changes = [(k, c, f"{2021 + i % 4}-{int(day[8:]) % 12 + 1:02}-{day[8:]}", i) for i, (k, c, day, _) in enumerate(some_changes(seed))]
    whole = spark.createDataFrame([], COLORS)
    for n, year in enumerate(order):
        part = [c for c in changes if c[2].startswith(str(2021 + year)) and (n == 0 or c[0] % 4 != 1)]
        delta = spark.createDataFrame(part, CHANGES)
        before = dimensions._parts(spark, root)
        touched = dimensions.apply_changes(spark, path, COLORS, ["id"], delta, latest_by=["tie"], buckets=4)
        whole = materialize(scd2.scd2_apply(whole, delta, ["id"], latest_by=["tie"]), "whole")
        assert rows(dimensions.read_dimension(spark, path, COLORS)) == rows(whole)
        after = dimensions._parts(spark, root)
        assert {b for part_, p in after.items() if before.get(part_) != p for b in part_[:1]} <= set(touched)
        reached = [part_ for part_, p in after.items() if before.get(part_) == p]
        assert all(part_ in reached for part_ in before if part_[1] < 2021 + year)
    # a reader of later days opens no year that was closed before
    late = dimensions.read_dimension(spark, path, COLORS, since="2024-01-01")
    assert not any(f"ended={y}" in f for f in late.inputFiles() for y in (2021, 2022, 2023))
    wanted = within_range(whole, "2024-01-01", "2025-01-01")
    assert rows(within_range(late, "2024-01-01", "2025-01-01")) == rows(wanted) and wanted.count() > 0


def test_a_stored_dimension_survives_a_stop_before_its_notes(spark, tmp_path):
    """Without the note of the largest key it is taken from the rows; a fold that is not committed does not count."""
    path, root = str(tmp_path / "dim"), tmp_path / "dim" / "base-64"
    first = spark.createDataFrame([(1, "r", "2024-01-01", 1), (2, "g", "2024-01-01", 2)], CHANGES)
    dimensions.apply_changes(spark, path, COLORS, ["id"], first, latest_by=["tie"])
    (root / "highest-1").unlink()
    (root / "fold=2" / "bucket=0").mkdir(parents=True)
    (root / "replaces-2").write_text('{"buckets": [0, 1, 2, 3], "since": 0}')
    assert dimensions.read_dimension(spark, path, COLORS).count() == 2
    dimensions.apply_changes(spark, path, COLORS, ["id"], spark.createDataFrame([(3, "b", "2024-01-02", 1)], CHANGES), latest_by=["tie"])
    assert rows(dimensions.read_dimension(spark, path, COLORS), "dwid", "id") == [(1, 1), (2, 2), (3, 3)]
    # what it was before the last fold can still be read
    assert dimensions.read_dimension(spark, path, COLORS, upto=1).count() == 2


@pytest.mark.parametrize("seed", range(3))
def test_late_days_leave_a_clean_timeline(spark, seed):
    """Increments applied in the wrong order: no overlaps, one open version, right value on every day."""
    changes = some_changes(seed)
    dim = spark.createDataFrame([], "dwid long, id long, color string, valid_from timestamp, valid_to timestamp, eff_flag boolean")
    for low, high in (("2024-01-10", "2024-02-01"), ("2024-01-01", "2024-01-10")):
        part = [c for c in changes if low <= c[2] < high]
        dim = scd2.scd2_apply(dim, spark.createDataFrame(part, CHANGES), ["id"], latest_by=["tie"], limit=0)
    got, want = defaultdict(list), defaultdict(list)
    for target, versions in ((got, rows(dim, *VERSION)), (want, expected_versions(changes))):
        for key, color, low, high, open_ in versions:
            target[key].append((low, high or datetime.max, color, open_))
    for key in want:
        assert sum(v[3] for v in got[key]) == 1
        timeline = sorted(got[key])
        assert all(a[1] == b[0] for a, b in zip(timeline, timeline[1:]))
        for day in range(25):
            instant = START + timedelta(days=day, hours=12)
            pick = lambda vs: [v[2] for v in vs if v[0] <= instant < v[1]]
            assert pick(got[key]) == pick(want[key])


def test_compat_fans_out_and_repeats(spark):
    dim = spark.createDataFrame([(1, 7, "r", START, None, True)],
                                "dwid long, id long, color string, valid_from timestamp, valid_to timestamp, eff_flag boolean")
    changes = spark.createDataFrame([(7, "g", "2024-01-02"), (7, "b", "2024-01-03")], "id long, color string, update_date string")
    out = scd2.scd2_apply(dim, changes, ["id"], compat=True)
    assert rows(out, "dwid", "color", "valid_to", "eff_flag") == [
        (1, "r", datetime(2024, 1, 2), False), (1, "r", datetime(2024, 1, 3), False),
        (2, "g", None, True), (3, "b", None, True)]


@pytest.mark.parametrize("unique, limit", [(False, None), (True, None), (True, 0)])
def test_merge_equals_brute_force_and_is_idempotent(spark, unique, limit):
    r = random.Random(5)
    kind = "id long, v string, update_time timestamp"
    time = lambda: START + timedelta(days=r.randrange(5))
    full = [(i, f"full{i}", time()) for i in range(30)]
    delta = [(i, f"delta{i}", time()) for i in list(range(20, 40))]
    best = {}
    for key, v, t in full + delta:  # the increment comes later, so it wins ties
        if key not in best or t >= best[key][1]:
            best[key] = (v, t)
    full_df, delta_df = spark.createDataFrame(full, kind), spark.createDataFrame(delta, kind)
    once = merge_latest(full_df, delta_df, ["id"], full_is_unique=unique, limit=limit)
    assert rows(once) == sorted([(k, *v) for k, v in best.items()], key=repr)
    assert rows(merge_latest(once, delta_df, ["id"], full_is_unique=unique, limit=limit)) == rows(once)


def test_numbering_is_contiguous_and_ordered(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("hot"))
    numbered = sorted(rows(number_rows(df, ["hot", "k"], start=100), "dwid", "hot", "k"))
    assert [n[0] for n in numbered] == list(range(101, 5101))
    assert [n[1:] for n in numbered] == sorted(n[1:] for n in numbered)


def test_numbering_of_nothing(spark):
    assert number_rows(spark.createDataFrame([], "k long"), ["k"]).count() == 0


def test_waves_and_dedup_equal_a_direct_read_when_lateness_is_short(spark):
    r = random.Random(3)
    data = []
    for i in range(300):
        ts = START + timedelta(microseconds=r.randrange(600_000_000)) if i % 5 else START + timedelta(seconds=5 * r.randrange(100))
        data.append((i, ts, ts + timedelta(seconds=r.randrange(60))))
    df = spark.createDataFrame(data, "id long, timestamp timestamp, arrival timestamp")
    waves = multi_wave_extract(df, "timestamp", "arrival")
    ticks = [int(START.timestamp()) + 5 * k for k in range(200)]
    expected = [(i, offset, t) for i, ts, arrival in data for offset in (0, 60) for t in ticks
                if t - offset - 5 < ts.timestamp() <= t - offset and arrival.timestamp() <= t]
    assert rows(waves, "id", "wave_offset", "read_tick") == sorted(expected, key=repr)
    assert rows(dedup_stream(waves.select("id", "timestamp"), ["id"], "timestamp")) == rows(df.select("id", "timestamp"))


def test_sliding_mean_equals_brute_force(spark):
    r = random.Random(1)
    data = [(i, "hot" if r.random() < 0.4 else f"h{r.randrange(4)}", r.randrange(100), START + timedelta(seconds=r.randrange(2000)))
            for i in range(400)]
    got = {(h, t): a for h, t, a in rows(sliding_mean(spark.createDataFrame(data, "id long, hostname string, value long, timestamp timestamp")))}
    groups = defaultdict(list)
    for _, host, value, ts in data:
        second = int(ts.timestamp())
        first = second - second % 5 + 5
        for end in range(first, first + 60, 5):
            groups[host, end].append(value)
    assert got.keys() == groups.keys()
    assert all(abs(got[k] - sum(v) / len(v)) < 1e-9 for k, v in groups.items())


def test_alert_state_does_not_depend_on_order(spark):
    kind = "server_id long, alert_id long, incident_ts long, status string"
    index = spark.createDataFrame([(1, "disk", 2, None, None), (2, "net", 1, None, None)], schemas.ALERT_INDEX)
    r = random.Random(2)
    data = [(r.randrange(3), r.randrange(1, 3), r.randrange(4), r.choice(["OPEN", "CLOSED"])) for _ in range(40)]
    results = set()
    for _ in range(3):
        r.shuffle(data)
        parts = [spark.createDataFrame(data[k::3], kind) for k in range(3)]
        registry = agg.merge_registries(*[agg.incident_registry(p) for p in parts])
        results.add(tuple(rows(agg.server_severity(registry, index))))
    assert len(results) == 1


@pytest.mark.parametrize("events, expected", [
    (["OPEN"], 2), (["OPEN", "CLOSED"], 0), (["CLOSED", "OPEN"], 0), (["CLOSED"], 0)])
def test_alert_severity_cases(spark, events, expected):
    alerts = spark.createDataFrame([(1, 1, 100, s) for s in events], "server_id long, alert_id long, incident_ts long, status string")
    index = spark.createDataFrame([(1, "disk", 2, None, None)], schemas.ALERT_INDEX)
    assert rows(agg.server_severity(agg.incident_registry(alerts), index)) == [(1, expected)]


def test_two_incidents_one_closed(spark):
    alerts = spark.createDataFrame([(1, 1, 100, "OPEN"), (1, 1, 100, "CLOSED"), (1, 1, 200, "OPEN")],
                                   "server_id long, alert_id long, incident_ts long, status string")
    index = spark.createDataFrame([(1, "disk", 2, None, None)], schemas.ALERT_INDEX)
    assert rows(agg.server_severity(agg.incident_registry(alerts), index)) == [(1, 2)]


def test_latest_per_key_prefers_the_first_in_order(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (2, 1, "c")], "k long, o long, v string")
    assert rows(latest_per_key(df, ["k"], [F.desc("o")]), "v") == [("b",), ("c",)]
