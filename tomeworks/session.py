"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE does the run-time work the plans rely on: it coalesces small shuffle
# partitions, splits skewed join partitions and turns a join into a broadcast
# once the real size of a side is known.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # counts of a stream live on disk, not in the executors' heap
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.parquet.compression.codec": "zstd",
}


def local_session(cpus: int = 8, memory: str = "16g", name: str = "tomeworks") -> SparkSession:
    """A single-machine session for tests and the benchmark.

    On a cluster the session comes from spark-submit; only ``SETTINGS`` matter
    there, and the shuffle partition count should follow the cluster's cores.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
