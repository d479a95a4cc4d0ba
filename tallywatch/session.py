"""Session settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Timestamps are instants; they are read and shown in UTC.
BATCH_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Other than the default these have statistics, by which filters on times skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Window and join state live on executor disk with changelog checkpoints, so
# state size is not bound by executor memory and survives executor loss.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # One state store per join partition instead of four.
    "spark.sql.streaming.join.stateFormatVersion": "3",
    # A batch's rows are kept for a few reads only: packing them costs more than those.
    "spark.sql.inMemoryColumnarStorage.compressed": "false",
    # Saves a lookup per write; progress then reports no total of state rows.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def configure(spark: SparkSession, streaming: bool = False) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in {**BATCH_CONF, **(STREAM_CONF if streaming else {})}.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: the one the cluster names in
    ``spark.checkpoint.dir``. A local temporary folder is used only on a local
    master where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="tallywatch-")
