"""A log of what has been written completely.

Data is written to a folder of its own first; then an entry, a small JSON file,
names it.  Readers only follow entries, so a write that fails or is still under
way is never seen, and what was committed before stays readable.  Entries are
numbered; each appears by one rename.  One writer at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from tomeworks.staging import children, exists, remove, target_of


class CommitLog:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _paths(self) -> list[str]:
        if not exists(self.spark, self.folder):
            return []
        return sorted(p for p in children(self.spark, self.folder) if p.endswith(".json"))

    def entries(self) -> list[dict]:
        """All entries in the order in which they were made."""
        return [json.loads(self._read(p)) for p in self._paths()]

    def last(self) -> dict | None:
        paths = self._paths()
        return json.loads(self._read(paths[-1])) if paths else None

    def forget(self) -> None:
        """Removes all entries but the last, for logs whose entries each tell everything."""
        for path in self._paths()[:-1]:
            remove(self.spark, path)

    def append(self, entry: dict) -> dict:
        """Adds an entry and returns it with its ``number``."""
        last = self.last()
        entry = {**entry, "number": 1 + last["number"] if last else 0}
        draft, files = target_of(self.spark, f"{self.folder}/.{uuid.uuid4().hex}")
        final, _ = target_of(self.spark, f"{self.folder}/{entry['number']:012d}.json")
        out = files.create(draft, False)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        if files.exists(final) or not files.rename(draft, final):
            files.delete(draft, False)
            raise RuntimeError(f"another writer has committed entry {entry['number']} of {self.folder}")
        return entry

    def _read(self, path: str) -> str:
        target, files = target_of(self.spark, path)
        stream = files.open(target)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
