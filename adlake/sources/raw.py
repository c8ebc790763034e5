"""Batch access to the raw layer."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from adlake.schemas import RAW
from adlake.sources import files
from adlake.sources.tables import balanced, read_folders


def raw_path(base: str, event_type: str) -> str:
    return f"{base}/{event_type}s"


def raw_days(spark: SparkSession, base: str, event_type: str) -> list[str]:
    """The days on which events of a type were ingested, from the folder names."""
    return files.partition_values(spark, raw_path(base, event_type), "raw_date")


def read_raw(
    spark: SparkSession, base: str, event_type: str, start: date | str, end: date | str
) -> DataFrame:
    """Raw events of one type ingested from ``start`` to ``end``, both included.

    The days' folders are named to the reader, so files of other days are never listed.
    """
    root, first, last = raw_path(base, event_type), str(start), str(end)
    held = [d for d in raw_days(spark, base, event_type) if first <= d <= last]
    return read_folders(spark, root, "raw_date", held, RAW[event_type])


def append_raw(
    events: DataFrame, base: str, event_type: str, tasks: int | None = None
) -> None:
    """Add decoded events to the raw layer, partitioned by arrival.

    AQE sizes the write, and an hour with a large share of the rows is cut into several tasks.
    ``tasks`` sets its parallelism instead, for backfills of few rows over many hours, where
    opening files is the work.
    """
    rows = events.select(*RAW[event_type].names)
    hours = ("raw_date", "raw_hour")
    if tasks:
        placed = rows.repartitionByRange(tasks, *hours, "kafka_partition", "kafka_offset")
    else:
        placed = balanced(rows, *hours)
    placed.write.mode("append").partitionBy(*hours).parquet(raw_path(base, event_type))
