"""Streams of raw messages with a ``value`` text column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.config import JobConfig


def kafka_messages(spark: SparkSession, job: JobConfig) -> DataFrame:
    """Message text, broker time and topic position. Needs the Kafka connector
    on the class path, so it is not exercised by the tests."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", job.brokers)
        .option("subscribe", job.topic)
        .option("startingOffsets", job.starting_offsets)
        .option("kafka.group.id", job.group_id)
    )
    if job.max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", job.max_offsets_per_trigger)
    return reader.load().select(
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("ingest_time"),
        F.concat_ws("/", "topic", F.col("partition").cast("string"), F.col("offset").cast("string")).alias("position"),
    )


def file_messages(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """One message per line of the text files that arrive in ``path``; a file's
    modification time stands in for the broker time."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select("value", F.col("_metadata.file_modification_time").alias("ingest_time"))
