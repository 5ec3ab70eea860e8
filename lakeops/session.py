"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Joins choose broadcast or shuffle from Catalyst's size estimate and AQE's
# measured sizes; a hot join key is split by the adaptive skew join, even where
# the split costs an extra shuffle downstream.
SCALE_CONF = {
    # A value that does not fit its type fails the query instead of turning into null.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# A task's memory goes by the rows it gets. With Spark's own values a stage has about as many tasks
# as the cluster has cores until each reads 64 MB, which narrow rows with long keys unpack to
# gigabytes in several sorts and hash maps; these values add tasks instead, so what one task holds
# stays as it is when tables grow. A partition that a null or hot key fills is split at a like size.
# A broadcast counts in every task that reads it, and the size Catalyst estimates knows neither what
# a file unpacks to nor the rows an explode adds: only what is tiny by estimate is broadcast for it,
# the rest where AQE has measured it. HotSpot interprets methods of over 8000 bytes, which dozens of
# measures in one generated loop exceed; past that, operators run one by one in compiled pieces.
TASK_CONF = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.files.maxPartitionBytes": "8m",
    "spark.sql.files.openCostInBytes": "1m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
}
# For plans whose joins all share some keys of which no value has many rows: rows that lie by the
# shared keys stay where they are in a join by these and more.
SHARED_KEYS_CONF = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
BROADCAST_THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"
MOST_ESTIMATED = 256 * 1024

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def tune(spark: SparkSession) -> SparkSession:
    return _set(spark, SCALE_CONF)


def bound_tasks(spark: SparkSession, conf: dict[str, str] | None = None) -> SparkSession:
    """Tasks of a bounded size, whatever the size of the tables; a session without broadcasts stays so.

    ``conf`` is what one query sets otherwise; the next one starts from ``TASK_CONF`` again.
    """
    settings = TASK_CONF | (conf or {})
    if spark.conf.get(BROADCAST_THRESHOLD) == "-1":
        return _set(spark, settings | {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    return _set(spark, settings | {BROADCAST_THRESHOLD: str(MOST_ESTIMATED)})


def _set(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    for key, value in settings.items():
        spark.conf.set(key, value)
    return spark


def use_checkpoints(spark: SparkSession, folder: str | None = None) -> str:
    """Point the session's checkpoints at the folder all executors share.

    The session's own setting counts; ``folder`` is for a session that names none, as in tests.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or folder
    if not folder:
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder every executor can read")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "6g") -> SparkSession:
    """A local session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lakeops")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
