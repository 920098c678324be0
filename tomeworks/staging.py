"""Stage tables: Parquet written once, read by every later step.

A stage table cuts lineage the durable way.  It lives in the shared folder the
cluster names in ``spark.checkpoint.dir``, so it survives the loss of any
executor, and being columnar it keeps column pruning and filter pushdown, which
an RDD checkpoint would not.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder stage tables go to: ``spark.checkpoint.dir`` when set.

    Only a local session may fall back to a temporary folder; on a cluster a
    machine-local path would be invisible to the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = "file:" + tempfile.mkdtemp(prefix="tomeworks-")
    return _LOCAL_ROOTS[app]


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, removed when the application ends."""
    root = shared_root(spark)
    path = f"{root}/tomeworks/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as a stage table and return a DataFrame that reads it."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    staged.stage_path = path
    return staged


def target_of(spark: SparkSession, path: str):
    """The path and its file system."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(context._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, files = target_of(spark, path)
    return files.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """The paths right below a folder."""
    target, files = target_of(spark, path)
    return [str(s.getPath()) for s in files.listStatus(target)]


def last_change(spark: SparkSession, path: str) -> int:
    """When a file or folder was last written, in milliseconds."""
    target, files = target_of(spark, path)
    return files.getFileStatus(target).getModificationTime()


def still_staged(df: DataFrame) -> bool:
    """Whether the files of a stage table are still there, for tables kept across jobs."""
    return exists(df.sparkSession, df.stage_path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder and all in it, if it is there."""
    target, files = target_of(spark, path)
    files.delete(target, True)
