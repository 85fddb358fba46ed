"""Session settings.

``configure`` holds the run-time settings the plans rely on, so that they also
apply to a session the caller built.  Sizes of the cluster (executors, memory,
shuffle partitions) stay with the caller.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    # Dates are cut from instants in the session zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a hot customer's partition in the fact joins even when a later
    # operator could have reused the join's partitioning.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Split a hot month or source system before a partitioned write.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Lists of values that are named to a scan, for its Bloom filters.
    "spark.sql.parquet.pushdown.inFilterThreshold": "400",
    # Rows of a batch that goes to Python; with long texts the default is many megabytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    # Progress reports a stream keeps for whoever adds them up.
    "spark.sql.streaming.numRecentProgressUpdates": "1000",
    # Merge a customer's events per input partition before the session shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Keep streaming state on local disk with changes logged to the checkpoint,
    # not on the executor heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "kinbridge", cores: int | str = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())
