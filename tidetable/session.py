"""Session settings the library relies on, and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below the cluster's ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one machine, may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="tidetable-")
    return f"{root.rstrip('/')}/tidetable-{uuid.uuid4().hex}"


def written_once(df: DataFrame) -> DataFrame:
    """A table that several parts of a plan read, written into the shared folder so that it is computed once."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def streaming_session(spark: SparkSession) -> SparkSession:
    """A sibling session for streaming jobs: UTC event times and state kept in RocksDB.

    A sibling shares the cluster and the catalog of files but not the SQL settings, so nothing changes for
    the caller's session. Shuffle partitions follow the caller, because they fix the number of state stores.
    """
    sibling = spark.newSession()
    sibling.conf.set("spark.sql.session.timeZone", "UTC")
    sibling.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    sibling.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    sibling.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    return sibling
