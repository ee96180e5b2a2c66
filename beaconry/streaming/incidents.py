"""Incidents as keyed state with timers: an incident leaves the state, and its host's rating, when it expires."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from beaconry import schemas

# rows of changed incidents, and of hosts whose pending messages may have changed
INCIDENT, HOST = "incident", "host"
CHANGES = T.StructType([
    *schemas.struct(hostname=schemas.STR, kind=schemas.STR, message=schemas.STR, incident_ts=schemas.LONG,
                    opened=schemas.BOOL, closed=schemas.BOOL, live=schemas.BOOL, as_of=schemas.LONG, seq=schemas.LONG).fields,
    T.StructField("pending", T.ArrayType(T.StringType()))])
# alerts go into the state function, and changes come out, as one text column each: a call costs more by the column than by the row
ALERT_FIELDS = ["hostname", "incident_ts", "message", "status", "as_of"]
PACKED = schemas.struct(changes=schemas.STR)
# state entries at most. Calling Python for an entry costs far more than a host's alerts do, so beyond this number hosts share entries
ENTRIES = 16_384
# by host: newest time, number of the last rating, and the flags of each incident by time and message
STATE = schemas.struct(hosts=schemas.STR)


def _entry_changes(ttl: int | None):
    """The state function: fold in the new alerts of an entry's hosts, drop what has expired, say what changed."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        hosts: dict[str, list] = json.loads(state.get[0]) if state.exists else {}
        # the changed incidents of each host that has new alerts or expired incidents
        changed: dict[str, dict[tuple[str, str], bool]] = {}
        for batch in () if state.hasTimedOut else batches:
            for host, ts, message, status, at in map(itemgetter(*ALERT_FIELDS), map(json.loads, batch["alert"].tolist())):
                ts = str(ts)
                held = hosts.setdefault(host, [None, 0, {}])
                flags = held[2].setdefault(ts, {}).setdefault(message, [False, False])
                changes = changed.setdefault(host, {})
                place = status == "CLOSED"
                if not flags[place]:
                    flags[place] = changes[ts, message] = True
                held[0] = at if held[0] is None else max(held[0], at)
        rows = []
        if ttl is not None:
            # the watermark is the newest time of the stream less the time to live
            watermark = state.getCurrentWatermarkMs()
            for host, held in hosts.items():
                for ts in [t for t in held[2] if int(t) * 1000 <= watermark]:
                    changes = changed.setdefault(host, {})
                    for message, flags in held[2].pop(ts).items():
                        changes.pop((ts, message), None)
                        rows.append((host, INCIDENT, message, int(ts), *flags, False, None, None, None))
                    held[0] = max(held[0], int(ts) + ttl)
        for host, changes in changed.items():
            held = hosts[host]
            as_of, held[1], incidents = held[0], held[1] + 1, held[2]
            rows += [(host, INCIDENT, m, int(t), *incidents[t][m], True, None, None, None) for t, m in changes]
            pending = {m for by in incidents.values() for m, (opened, closed) in by.items() if opened and not closed}
            rows.append((host, HOST, None, None, None, None, None, as_of, held[1], sorted(pending)))
        state.update((json.dumps(hosts),))
        times = [int(t) for held in hosts.values() for t in held[2]] if ttl is not None else []
        if times:
            # a timer goes off once the watermark has passed it
            state.setTimeoutTimestamp(max(min(times) * 1000 - 1, watermark + 1))
        yield pd.DataFrame({"changes": [json.dumps([dict(zip(CHANGES.names, row)) for row in rows])]})

    return update


def incident_changes(alerts: DataFrame, ttl: int | None, clock: Callable[[], int] | None = None) -> DataFrame:
    """What a stream of accepted alerts changes: incidents, and the pending messages of the hosts concerned.

    An incident lives while it is younger than ``ttl`` seconds at the newest alert time of the whole stream, whichever
    host that alert is of; then its host is rated anew. An alert that is older on arrival counts for nothing. Time is
    never later than the clock (the time of the batch, or the given clock's time at the start of the query), so an alert
    dated in the future expires nothing. Without a time to live no alert is ever too late and nothing is forgotten.
    Folding is a logical or, so neither the order of alerts nor a repeated one changes what is held.

    A batch has one row per host concerned, stamped with event time, ``as_of``, which never goes back, and numbered per
    host by ``seq``.
    A batch reads and writes the state entries of the hosts it names or whose incidents expire, and no other. A host has
    an entry of its own as long as there are few beside ``ENTRIES``; of more hosts, those of equal hash share one.
    """
    now = F.lit(clock()).cast("timestamp") if clock else F.current_timestamp()
    timed = alerts.select("hostname", "message", "status", F.unix_timestamp("timestamp").alias("incident_ts"),
                          F.least("timestamp", now).alias("event_time"))
    timed = timed.withColumn("as_of", F.unix_timestamp("event_time"))
    if ttl is not None:
        timed = timed.withWatermark("event_time", f"{ttl} seconds")
    timeout = GroupStateTimeout.NoTimeout if ttl is None else GroupStateTimeout.EventTimeTimeout
    alert = F.to_json(F.struct(*ALERT_FIELDS), {"ignoreNullFields": "false"}).alias("alert")
    entry = F.pmod(F.xxhash64("hostname"), F.lit(ENTRIES)).cast("string").alias("entry")
    packed = timed.select(entry, alert, *(["event_time"] if ttl is not None else []))
    changed = packed.groupBy("entry").applyInPandasWithState(_entry_changes(ttl), PACKED, STATE, "update", timeout)
    return changed.select(F.inline(F.from_json("changes", T.ArrayType(CHANGES))))
