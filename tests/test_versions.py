"""Tables by version and by run."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from tomeworks.sources.versions import RunTable, VersionedTable


def failing(spark, n):
    """A frame whose last rows cannot be computed."""
    broken = F.when(F.col("id") < n - 1, F.col("id")).otherwise(F.raise_error(F.lit("lost")))
    return spark.range(0, n, 1, 4).select(broken.cast("bigint").alias("id"))


def ids(df):
    return sorted(r.id for r in df.collect())


def test_readers_see_the_last_complete_version(spark, tmp_path):
    table = VersionedTable(spark, f"file:{tmp_path}/t")
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.write(spark.range(3)) == 0
    reading = table.read()
    with pytest.raises(Exception, match="lost"):
        table.write(failing(spark, 40))
    assert ids(table.read()) == [0, 1, 2]
    assert table.write(spark.range(5)) == 1
    assert ids(reading) == [0, 1, 2]  # began before the second version
    assert ids(table.read()) == [0, 1, 2, 3, 4] and ids(table.read(0)) == [0, 1, 2]
    table.write(spark.range(1).withColumn("more", F.lit("x")), partition_by=("more",))
    assert table.read().columns == ["id", "more"]
    with pytest.raises(FileNotFoundError):
        table.read(0)  # two are kept
    assert not glob.glob(f"{tmp_path}/t/data/{table.log.entries()[0]['place']}")


def test_a_run_counts_once(spark, tmp_path):
    table = RunTable(spark, f"file:{tmp_path}/r")
    made = []

    def make():
        made.append(1)
        return spark.range(4)

    with pytest.raises(Exception, match="lost"):
        table.add("first", lambda: failing(spark, 40))
    assert table.runs() == []
    assert table.add("first", make) and not table.add("first", make)
    assert table.add("second", lambda: spark.range(10, 12))
    assert len(made) == 1
    rows = table.read().collect()
    assert sorted((r.run, r.id) for r in rows) == [("first", i) for i in range(4)] + [("second", 10), ("second", 11)]
    assert all(r.run_seconds > 0 and r.run_at is not None for r in rows)
