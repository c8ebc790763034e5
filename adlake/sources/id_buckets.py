"""Stored impressions placed by id, so that a batch is matched without moving them.

The row-level table is stored by day. Matching a batch that reaches back over many days shuffles
the id columns of all of them. Here the columns that matching needs lie in buckets of their id,
sorted; a batch placed the same way is joined bucket by bucket, and only the batch is shuffled.
Ids and times never change, so the table only grows; flags are those at the time of storing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.operators.attribution import match_events
from adlake.operators.dedup import ARRIVAL_ORDER

COLUMNS = ("event_id", "event_date", "event_time", "click", "conversion")


class IdBuckets:
    """The table at ``path``, opened or begun; ``buckets`` must be what it was begun with."""

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = f"id_buckets_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} (event_id STRING, event_date DATE, event_time TIMESTAMP, "
            f"click INT, conversion INT) USING parquet CLUSTERED BY (event_id) SORTED BY (event_id) "
            f"INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, silver: DataFrame) -> None:
        """Add row-level rows; one file for each bucket they fall into."""
        (
            silver.select(*COLUMNS)
            .repartition(self.buckets, "event_id")
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "event_id")
            .sortBy("event_id")
            .saveAsTable(self.table, path=self.path)
        )

    def match(self, events: DataFrame, window: int) -> DataFrame:
        """:func:`match_events` against this table. The batch is shuffled once, for its own
        deduplication and the join alike; stored rows stay where they are."""
        narrow = events.select("eid", "timestamp", *ARRIVAL_ORDER)
        return match_events(narrow.repartition(self.buckets, F.col("eid")), self.read(), window)

    def close(self) -> None:
        """Forgets the table's name; the files stay, also for results still to be read."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
