"""What earlier runs have processed (a name and a version each), as small files.

A run that succeeds commits one file, so a run that fails before its commit
leaves no trace and is repeated whole. Every ``SNAPSHOT_EVERY`` commits the
file holds all entries and the older ones go. Commits are renames: a reader
sees a whole file or none. One writer at a time is assumed, as for the tables
that the manifest describes.

Entries name folders, never rows: the driver holds as many as Spark's own
listing of the same table does.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import SparkSession

from cargolens.session import delete_path, glob_paths, read_text, write_text

SNAPSHOT_EVERY = 50


class Manifest:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _runs(self) -> list[tuple[int, str]]:
        found = glob_paths(self.spark, f"{self.path}/run-*.json")
        return sorted((int(re.search(r"run-(\d+)\.json$", p)[1]), p) for p in found)

    def exists(self) -> bool:
        return bool(self._runs())

    def entries(self) -> dict[str, str]:
        """Name -> version of all that was committed."""
        out: dict[str, str] = {}
        for _, path in self._runs():
            content = json.loads(read_text(self.spark, path))
            out = dict(content["entries"]) if content["whole"] else {**out, **content["entries"]}
        return out

    def commit(self, entries: dict[str, str]) -> None:
        """Add entries, or replace those of the same name."""
        runs = self._runs()
        number = runs[-1][0] + 1 if runs else 0
        whole = len(runs) >= SNAPSHOT_EVERY
        if whole:
            entries = {**self.entries(), **entries}
        text = json.dumps({"whole": whole, "entries": entries}, sort_keys=True)
        write_text(self.spark, f"{self.path}/run-{number:08d}.json", text)
        if whole:
            for _, path in runs:
                delete_path(self.spark, path)

    def clear(self) -> None:
        delete_path(self.spark, self.path)
