"""Streaming sources with one message per row: ``value, partition, offset, timestamp``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adlake.schemas import TOPIC_FILE


def read_kafka_topic(
    spark: SparkSession,
    topic: str,
    servers: str,
    offsets: str = "latest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Subscribe to a Kafka topic. The Kafka package must be on the session's class path.

    Offsets that expired before they were read are skipped rather than failing the stream.
    """
    if offsets not in ("latest", "earliest"):
        raise ValueError(f"offsets must be latest or earliest, not {offsets!r}")
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", offsets)
        .option("failOnDataLoss", "false")
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select("value", "partition", "offset", "timestamp")


def read_file_topic(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A folder of JSON lines that carry the same four columns as fields."""
    reader = spark.readStream.schema(TOPIC_FILE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)
