"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this library expects. Sizes (executors, memory, shuffle partitions) belong to the
# deployment; these only switch on run-time re-planning and pin what results depend on.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Folders are listed in at most so many tasks; Spark's own limit makes a task of every folder of a table of 10,000.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "96",
}

# State in RocksDB, uploaded as changes rather than whole files, with one store per join instead of four.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}

def configure(spark: SparkSession) -> SparkSession:
    """Apply SETTINGS to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def streaming_session(spark: SparkSession) -> SparkSession:
    """A sibling session for stateful queries: STATE_SETTINGS and one state partition per core.

    The number of state partitions is frozen by the first checkpoint of a query, and AQE does not coalesce stateful
    shuffles, so it is set from the cluster's cores rather than left at the batch default.
    """
    sibling = configure(spark.newSession())
    for key, value in STATE_SETTINGS.items():
        sibling.conf.set(key, value)
    sibling.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return sibling


def plain_checkpoints(session: SparkSession) -> SparkSession:
    """Has the streams of a session write their checkpoints through Hadoop's file systems if shared_dir is on a local one.

    Spark prefers its file contexts, which on a local disk start 30 processes a trigger (chmod, and readlink around each
    rename). One stream writes to a checkpoint, so that its renames need no more than these file systems give.
    """
    place = session.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(session))
    if place.getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).getScheme() == "file":
        session.conf.set(
            "spark.sql.streaming.checkpointFileManagerClass",
            "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager",
        )
    return session


def shared_dir(spark: SparkSession) -> str:
    """Folder visible to every executor, for written tables and stream checkpoints.

    Taken from ``spark.checkpoint.dir``. Only a local-mode session may run without it; its folder is in the warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shared/{context.applicationId}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The table written to the shared folder and read again: computed once, with no lineage, and safe from lost executors."""
    path = f"{shared_dir(df.sparkSession)}/fleetpulse/{purpose}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
