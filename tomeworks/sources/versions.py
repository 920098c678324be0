"""Tables that are replaced or added to as a whole, and never seen half written."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomeworks.sources.commits import CommitLog
from tomeworks.staging import remove


class VersionedTable:
    """A table of which every write makes a new version; readers get the last that is complete.

    The version before it stays, for readers that began before; older ones are removed.
    """

    def __init__(self, spark: SparkSession, folder: str, keep: int = 2):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.keep = keep
        self.log = CommitLog(spark, f"{self.folder}/versions")

    def write(self, df: DataFrame, partition_by: tuple[str, ...] = ()) -> int:
        """Writes a new version and returns its number."""
        place = uuid.uuid4().hex
        df.write.partitionBy(*partition_by).parquet(f"{self.folder}/data/{place}")
        entry = self.log.append({"place": place, "schema": df.schema.json()})
        for old in self.log.entries()[: -self.keep]:
            remove(self.spark, f"{self.folder}/data/{old['place']}")
        return entry["number"]

    def version(self) -> int | None:
        """The number of the last version, None before the first."""
        last = self.log.last()
        return last["number"] if last else None

    def read(self, version: int | None = None) -> DataFrame:
        """The last version, or one that is still kept."""
        entries = self.log.entries()
        entry = next((e for e in entries[-self.keep :][::-1] if version in (None, e["number"])), None)
        if entry is None:
            raise FileNotFoundError(f"no version {'' if version is None else version} in {self.folder}")
        return self.spark.read.parquet(f"{self.folder}/data/{entry['place']}")


class RunTable:
    """Rows of several runs, such as metrics: (run, run_seconds, run_at, the columns of the rows).

    A run's rows are added once: when its name is in the log already, nothing
    is computed.  Runs that failed leave no rows behind that a reader would see.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.log = CommitLog(spark, f"{self.folder}/runs")

    def runs(self) -> list[str]:
        return [e["run"] for e in self.log.entries()]

    def add(self, run: str, make: Callable[[], DataFrame]) -> bool:
        """Adds what ``make`` returns and the seconds it takes to make and write it; False if the run is there."""
        if run in self.runs():
            return False
        started = time.time()
        place = uuid.uuid4().hex
        make().write.parquet(f"{self.folder}/rows/place={place}")
        self.log.append({"run": run, "place": place, "seconds": time.time() - started, "at": started})
        return True

    def read(self) -> DataFrame:
        """All rows of all complete runs; there must be one."""
        entries = self.log.entries()
        paths = [f"{self.folder}/rows/place={e['place']}" for e in entries]
        rows = self.spark.read.option("basePath", f"{self.folder}/rows").parquet(*paths)
        runs = self.spark.createDataFrame(
            [(e["place"], e["run"], e["seconds"], e["at"]) for e in entries],
            "place string, run string, run_seconds double, at double",
        )
        found = rows.join(F.broadcast(runs), "place")  # a row a run
        others = [c for c in rows.columns if c != "place"]
        return found.select("run", "run_seconds", F.timestamp_seconds("at").alias("run_at"), *others)
