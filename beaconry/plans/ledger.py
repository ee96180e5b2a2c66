"""What a warehouse build has done so far, so that a stopped one goes on and readers see finished days only."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import SparkSession

from beaconry.sources.files import delete, listed, read_text, write_text

T = TypeVar("T")
OPEN, STEP, PUBLISHED = "run.json", "step=", "published"


class Run:
    """The build of one range of days. Its folder holds a note on the run and an empty file per finished step.

    A run that was stopped is continued by the next build of the same range with the same ``token``: finished steps are
    not done again, and the import time of the first attempt stays. A token stands for the input; with another one,
    or after the run has been published, the range is built anew from its first step. Every step may be repeated,
    since one that ended without its mark is.
    """

    def __init__(self, spark: SparkSession, root: str, start: str, end: str, now: str, token: str = "",
                 on_step: Callable[[str], None] | None = None):
        self.spark, self.root, self.on_step = spark, f"{root}/_runs", on_step
        self.start, self.end = start[:10], end[:10]
        self.name = f"{self.start}_{self.end}"
        self.folder = f"{self.root}/{self.name}"
        self._lock = threading.Lock()
        note = json.loads(read_text(spark, f"{self.folder}/{OPEN}") or "{}")
        self.resumed = note.get("token") == token
        if not self.resumed:
            delete(spark, self.folder)
            note = {"token": token, "now": now, "start": self.start, "end": self.end}
            write_text(spark, f"{self.folder}/{OPEN}", json.dumps(note))
        self.now: str = note["now"]
        self.done = {n.replace("-", "/", 1) for n in listed(spark, self.folder, STEP)}

    def step(self, name: str, action: Callable[[], T]) -> T | None:
        """Do a step, unless an earlier attempt has finished it."""
        if name in self.done:
            return None
        result = action()
        write_text(self.spark, f"{self.folder}/{STEP}{name.replace('/', '-', 1)}", "")
        with self._lock:
            self.done.add(name)
        if self.on_step:
            self.on_step(name)
        return result

    def publish(self, versions: dict[str, int]) -> None:
        """Show the range to readers, together with the versions of the replaced tables that belong to it."""
        before = published(self.spark, self.root)
        record = {"ranges": merged([*before["ranges"], [self.start, self.end]]), "versions": versions}
        folder = f"{self.root}/{PUBLISHED}"
        number = 1 + max((int(n) for n in listed(self.spark, folder) if n.isdigit()), default=0)
        write_text(self.spark, f"{folder}/{number}", json.dumps(record))
        for name, path in listed(self.spark, folder).items():
            if name.isdigit() and int(name) < number - 1:
                delete(self.spark, path)
        delete(self.spark, self.folder)


def merged(ranges: list[list[str]]) -> list[list[str]]:
    """Half-open ranges of days as few, sorted, without overlaps."""
    out: list[list[str]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


def without(ranges: list[list[str]], gone: list[list[str]]) -> list[list[str]]:
    """Ranges less other ranges."""
    for low, high in gone:
        ranges = [r for a, b in ranges for r in ([a, min(b, low)], [max(a, high), b]) if r[0] < r[1]]
    return ranges


def published(spark: SparkSession, root: str) -> dict:
    """The newest published record; it appears whole or not at all."""
    folder = f"{root}/{PUBLISHED}"
    newest = max((int(n) for n in listed(spark, folder) if n.isdigit()), default=None)
    return json.loads(read_text(spark, f"{folder}/{newest}")) if newest is not None else {"ranges": [], "versions": {}}


def visible(spark: SparkSession, root: str) -> tuple[list[list[str]], dict[str, int]]:
    """The ranges of days readers may see, which leaves out days that are being built again, and the table versions."""
    record = published(spark, f"{root}/_runs")
    running = []
    for name, path in listed(spark, f"{root}/_runs").items():
        note = None if name == PUBLISHED else read_text(spark, f"{path}/{OPEN}")
        if note:
            running.append([json.loads(note)["start"], json.loads(note)["end"]])
    return without(record["ranges"], running), record["versions"]
