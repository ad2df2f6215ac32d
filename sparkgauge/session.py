"""Session settings and shared-folder helpers used by every job."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Times are instants in UTC; a key that several sections have is decided by their order, not an
# error; adaptive execution re-plans joins and splits skewed partitions.
SESSION_SETTINGS = {
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    # Times with statistics: filters on them reach the row groups of files the jobs write.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Stream state outgrows executor memory: keep it in RocksDB with incremental checkpoints.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to an existing session."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, given: dict[str, str]) -> Iterator[None]:
    """Settings of the session within a block, as they were after it."""
    before = {key: spark.conf.get(key, None) for key in given}
    try:
        for key, value in given.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors reach: the session's checkpoint folder.

    Only a local-mode session without the setting gets a temporary folder.
    """
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="run-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder, for state or job output."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the frame to a table of its own in the shared folder and read on from there.

    The input is computed once, survives lost executors, and its size is known to the planner.
    """
    path = fresh_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
