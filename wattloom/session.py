"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime settings every plan in this package relies on. They are safe to set on a
# session somebody else created, because none of them is a static configuration.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Envelopes take ten times their Parquet size in memory, where a task sorts them by key.
    "spark.sql.files.maxPartitionBytes": "32m",
    # Streaming state on local disk with snapshots in the checkpoint folder, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the time zone and adaptive execution on an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wattloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str | None:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local master gets a fresh folder under /tmp; on a cluster there is
    no safe default (a machine-local path would not be visible to the executors), so None.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if named is None and sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        named = sc.getCheckpointDir()
    return named
