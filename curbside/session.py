"""Session settings and the shared folders that jobs write intermediate tables to."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Time zone of every timestamp computation; partition values stay strings on read.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # split hot join keys even where that costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Adaptive execution packs small shuffle partitions into tasks of so many bytes at most. Stored bytes are some 20 times
# smaller than the rows a task sorts and groups: at the usual 64 MB that took over 1 GB of a task's memory.
TASK_BYTES_KEY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
TASK_BYTES = 16 << 20

BUILD_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def get_spark(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Build a session. The cluster manager picks the master unless one is given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BUILD_SETTINGS, **RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_settings(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings on a session built elsewhere; a smaller size of tasks stays."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    size = spark.conf.get(TASK_BYTES_KEY, None)
    if size is None or spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size) > TASK_BYTES:
        spark.conf.set(TASK_BYTES_KEY, str(TASK_BYTES))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it in `spark.checkpoint.dir`.

    Where nothing is configured a local master gets a temporary folder; on a cluster that would be a folder of each
    machine's own, so it is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder all machines share (master {master})")
        configured = tempfile.mkdtemp(prefix="curbside-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Later steps that branch over the same rows then agree on them, need no recomputation,
    and survive the loss of any executor.
    """
    return settle_at(df, fresh_folder(df.sparkSession, name))


def settle_at(df: DataFrame, path: str) -> DataFrame:
    """`settle` into a given folder, for callers that discard it when they are done."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing will read again."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
