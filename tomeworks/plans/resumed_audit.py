"""An audit that goes on where the last one stopped.

A corpus arrives in runs.  Each run audits its own files only: their texts are
read once for the ids, and the ids are looked up in the index of ids found GOOD
before.  Statuses of earlier runs are neither read nor written again, and folds
go on from the number of GOOD files so far, kept in the commit log.

The statuses of all runs equal one audit of all files, ordered by run, then
``seq``, as long as the metadata of the ids seen stays the same.  An id that
had no metadata then and has some now becomes GOOD with its next file.

A run is committed last.  One that failed may be repeated under its name; one
that is committed is not done again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeworks.functions.markup import document_id
from tomeworks.operators.audit import file_statuses, with_audit_folds, with_known_metadata
from tomeworks.sources.commits import CommitLog
from tomeworks.sources.key_index import KeyIndex, Layout
from tomeworks.staging import stage

_SCHEMA = "seq bigint, file string, doc_key string, status string, fold int"


class AuditLog:
    """Statuses of the runs below ``folder``: (run, seq, file, doc_key, status, fold)."""

    def __init__(self, spark: SparkSession, folder: str, layout: Layout = Layout()):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.log = CommitLog(spark, f"{self.folder}/runs")
        self.index = KeyIndex(spark, f"{self.folder}/ids", layout)

    def runs(self) -> list[str]:
        return [entry["run"] for entry in self.log.entries()]

    def _read(self, entry: dict) -> DataFrame:
        rows = self.spark.read.schema(_SCHEMA).parquet(f"{self.folder}/statuses/{entry['place']}")
        return rows.select(F.lit(entry["run"]).alias("run"), "*")

    def statuses(self, run: str | None = None) -> DataFrame:
        """Of one run, or of all."""
        entries = [e for e in self.log.entries() if run in (None, e["run"])]
        result = self.spark.createDataFrame([], f"run string, {_SCHEMA}")
        for entry in entries:
            result = result.unionByName(self._read(entry))
        return result

    def audit(self, files: DataFrame, metadata: DataFrame, run: str) -> DataFrame:
        """Audits files (seq, file, text) against metadata (doc_key); returns the run's statuses.

        ``seq`` is unique in the run.
        """
        entries = self.log.entries()
        if run in [e["run"] for e in entries]:
            return self.statuses(run)
        good_before = entries[-1]["good"] if entries else 0
        ids = stage(files.select("seq", "file", document_id(F.col("text")).alias("doc_key")), "ids")
        found = with_known_metadata(ids.where(F.col("doc_key").isNotNull()), metadata, "doc_key")
        # a run that failed between index and commit has its own ids in the index already
        seen = self._seen_before(found.select("doc_key").distinct(), run)
        judged = stage(file_statuses(ids, metadata, seen=seen), "statuses")
        place = uuid.uuid4().hex
        with_audit_folds(judged, good_before=good_before).select(
            F.col("seq").cast("bigint"), "file", "doc_key", "status", "fold"
        ).write.parquet(f"{self.folder}/statuses/{place}")
        written = self._read({"run": run, "place": place})
        good = written.where(F.col("status") == "GOOD")
        n_good = good.count()
        self.index.add(good.select("doc_key"), run)
        self.log.append({"run": run, "place": place, "good": good_before + n_good})
        return self.statuses(run)

    def compact(self) -> None:
        """Merges the ids of all runs; not while a run is under way."""
        if self.index.names() <= set(self.runs()):
            self.index.compact()

    def _seen_before(self, keys: DataFrame, run: str) -> DataFrame:
        self.index.drop(run)
        return stage(self.index.seen(keys), "seen")
