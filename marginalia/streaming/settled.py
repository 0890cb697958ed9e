"""A streaming source of staged files that have come to rest.

Files count from the second level (collection/file) once nothing has changed
them for some seconds. Each new lot is written down as a plan before it is
offered; an offset is the number of the last plan. A restart therefore reads
neither more nor less, whatever times the files carry.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from marginalia.sources.shared import opened, publish

# Seconds without a change, and names that one task reads.
SETTLE = 3.0
NAMES_PER_TASK = 1000

SCHEMA = "path string, modificationTime timestamp, length long"


class Names(InputPartition):
    def __init__(self, rows: list[tuple[str, float, int]]):
        self.rows = rows


class SettledReader(DataSourceStreamReader):
    def __init__(self, root: str, plans: str, settle: float):
        self.root, self.plans, self.settle = root.rstrip("/"), plans.rstrip("/"), settle
        self.seen: set[tuple[str, float, int]] = set()
        self.last = 0

    def _plan(self, number: int) -> list[tuple[str, float, int]]:
        store, path = opened(f"{self.plans}/{number:09d}.json")
        with store.open_input_stream(path) as source:
            return [tuple(row) for row in json.loads(source.read())]

    def _recall(self) -> None:
        """Plans this reader has not seen, in order."""
        store, path = opened(f"{self.plans}/{self.last + 1:09d}.json")
        while store.get_file_info(path).type == pafs.FileType.File:
            self.last += 1
            self.seen.update(self._plan(self.last))
            path = f"{path.rpartition('/')[0]}/{self.last + 1:09d}.json"

    def settled(self) -> list[tuple[str, float, int]]:
        """Files at collection/file, not hidden, at rest, in the form they have now."""
        store, root = opened(self.root)
        root = root.rstrip("/")
        listed = store.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
        latest = time.time() - self.settle
        found = []
        for info in listed:
            parts = info.path.removeprefix(root).strip("/").split("/")
            if info.type != pafs.FileType.File or len(parts) != 2 or any(p.startswith((".", "_")) for p in parts):
                continue
            changed = info.mtime.timestamp()
            if changed <= latest:
                found.append((f"{self.root}/{'/'.join(parts)}", changed, info.size))
        return sorted(found)

    def initialOffset(self) -> dict:
        return {"plan": 0}

    def latestOffset(self) -> dict:
        self._recall()
        fresh = [row for row in self.settled() if row not in self.seen]
        if fresh:
            publish(f"{self.plans}/{self.last + 1:09d}.json", [json.dumps(fresh).encode()])
            self._recall()
        return {"plan": self.last}

    def partitions(self, start: dict, end: dict) -> list[Names]:
        rows = [row for number in range(start["plan"] + 1, end["plan"] + 1) for row in self._plan(number)]
        return [Names(rows[a : a + NAMES_PER_TASK]) for a in range(0, len(rows), NAMES_PER_TASK)]

    def read(self, partition: Names) -> Iterator[tuple]:
        for path, changed, size in partition.rows:
            yield path, datetime.fromtimestamp(changed, timezone.utc), size


class SettledFiles(DataSource):
    """Options: ``path`` (staging folder), ``plans`` (shared folder of this stream's plans), ``settle`` (seconds)."""

    @classmethod
    def name(cls) -> str:
        return "settled_files"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> SettledReader:
        return SettledReader(self.options["path"], self.options["plans"], float(self.options.get("settle", SETTLE)))
