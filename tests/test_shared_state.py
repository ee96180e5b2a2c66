"""Incident state when hosts share entries: calls of the state function are bounded, results are those of single hosts."""

import json
from types import SimpleNamespace

import pandas as pd
import pytest

from beaconry.streaming import alerts as al
from beaconry.streaming import incidents, streams
from tests.helpers import rows
from tests.test_streaming import T0, Folder, alert, current, masters, run_alerts  # noqa: F401  (masters is a fixture)


@pytest.mark.parametrize("entries", [1, 16_384])
def test_hosts_that_share_an_entry_are_rated_alone(spark, masters, tmp_path, monkeypatch, entries):  # noqa: F811
    monkeypatch.setattr(incidents, "ENTRIES", entries)
    folder, root = Folder(spark, tmp_path / "in"), str(tmp_path / "out")
    folder.add("al", alert(1, "OPEN", 0), alert(2, "OPEN", 30, "svr2", "net"))
    run_alerts(folder, masters, root)
    assert current(spark, root) == {1: 2, 2: 1}
    # only the other server's alert moves time on: the first one's incident expires, the second's older one is closed
    folder.add("al", alert(3, "OPEN", 70, "svr2"), alert(4, "CLOSED", 30, "svr2", "net"))
    run_alerts(folder, masters, root)
    assert current(spark, root) == {1: 0, 2: 2}
    states = {(r.server_id, r.timestamp - T0): r.severity for r in streams.read_states(spark, root, ["alert"]).collect()}
    assert states[1, 5] == 2 and states[1, 65] == 0
    registry = al.read_registry(spark, f"{root}/registry")
    assert rows(registry, "server_id", "incident_ts", "opened", "closed") == [
        (2, T0 + 30, True, True), (2, T0 + 70, True, False)]


class Held:
    """State of one entry as Spark hands it over."""

    exists, hasTimedOut, get, timer = False, False, None, None

    def __init__(self, watermark: int):
        self.watermark = watermark

    def getCurrentWatermarkMs(self):
        return self.watermark

    def update(self, value):
        self.exists, self.get = True, value

    def setTimeoutTimestamp(self, at):
        self.timer = at


def test_only_hosts_concerned_are_given_out():
    def call(state, *alerts):
        packed = [json.dumps(dict(zip(incidents.ALERT_FIELDS, a))) for a in alerts]
        (out,) = incidents._entry_changes(60)(("7",), iter([pd.DataFrame({"alert": packed})]), state)
        return [SimpleNamespace(**r) for r in json.loads(out["changes"][0])]

    state = Held(0)
    first = call(state, ("a", 100, "disk", "OPEN", 100), ("b", 130, "net", "OPEN", 130))
    assert [(r.hostname, r.seq, r.pending) for r in first if r.kind == "host"] == [("a", 1, ["disk"]), ("b", 1, ["net"])]
    assert state.timer == 99_999
    again = call(state, ("b", 131, "net", "CLOSED", 131))
    assert {r.hostname for r in again} == {"b"}
    state.watermark, state.hasTimedOut = 100_000, True
    gone = call(state)
    assert [(r.hostname, r.kind, r.live, r.as_of, r.seq) for r in gone] == [
        ("a", "incident", False, None, None), ("a", "host", None, 160, 2)]
    assert state.timer == 129_999
