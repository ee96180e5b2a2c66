"""How the alert stream's work is dealt out to tasks."""

import glob
from datetime import datetime, timedelta

import pyarrow.parquet as pq

from beaconry import schemas
from beaconry.queries import alerting
from beaconry.queries.adapters import EVENTS, Tables
from beaconry.streaming import alerts as al
from beaconry.streaming.incidents import CHANGES


def test_a_batch_is_whole_before_a_sink_looks_at_it(spark):
    server = spark.createDataFrame([(i, f"svr{i}") for i in range(8)], "id long, hostname string")
    index = spark.createDataFrame([(1, "disk", 2, None, None)], schemas.ALERT_INDEX)
    batch = spark.createDataFrame([(f"svr{i}", "host", None, None, None, None, None, 100, 1, ["disk"]) for i in range(8)], CHANGES)
    cached = lambda: {i.id(): (i.numCachedPartitions(), i.numPartitions())
                      for i in spark.sparkContext._jsc.sc().getRDDStorageInfo()}
    before, seen, states = cached(), [], []

    def registry(rows, batch_id):
        seen.extend(v for k, v in cached().items() if k not in before)

    al.change_sink(lambda: server, lambda: index, registry, lambda rows, i: states.extend(rows.collect()))(batch, 0)
    assert seen and all(held == parts for held, parts in seen)
    assert sorted((r.server_id, r.severity) for r in states) == [(i, 2) for i in range(8)]


def test_large_message_files_have_several_row_groups(spark, tmp_path, monkeypatch):
    start = datetime(2024, 1, 1)
    events = [(i, start + timedelta(minutes=i), i % 50, ("error", "signup")[i % 2], 1.0, "") for i in range(3000)]
    spark.createDataFrame(events, EVENTS).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(i, f"c{i}", 1, 0.0, "x") for i in range(50)], "c_custkey long, c_name string, c_nationkey int, "
                          "c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    monkeypatch.setattr(alerting, "ROW_GROUP", 4096)
    monkeypatch.setattr(alerting.streams, "alert_stream", lambda *a, **b: [])
    root = alerting.run_alert_stream(Tables(spark, str(tmp_path)), None).removeprefix("file://")
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{root}/trunk/*.parquet")]
    assert len(files) == 4 and all(f.num_row_groups > 1 for f in files)
    assert sum(f.num_rows for f in files) == 3000
