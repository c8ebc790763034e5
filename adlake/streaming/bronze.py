"""Topics to the raw layer: one stateless append query per topic.

There is no watermark. Partitions follow ingest time, so an event arriving a month late lands
in today's partition and the batch attributes it by its event time.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from adlake.schemas import EVENT_TYPES, PAYLOADS, REQUIRED_EVENT_COLUMNS, all_present
from adlake.sources.raw import raw_path
from adlake.sources.tables import Lake

# Names of what streams observe begin with this.
MEASURES = "bronze_"


def parse_topic(messages: DataFrame, event_type: str, ingest_ts: Column | None = None) -> DataFrame:
    """Decode messages and add arrival metadata.

    A message that does not decode gives NULL event fields; it is kept in the raw layer with
    its offset and set aside when the batch reads it. Ingest time is the start of the
    micro-batch.
    """
    decoded = F.from_json(F.col("value").cast("string"), PAYLOADS[event_type])
    stamped = messages.select(
        decoded.alias("event"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        (F.current_timestamp() if ingest_ts is None else ingest_ts).alias("ingest_ts"),
    )
    return stamped.select(
        "event.*",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        "ingest_ts",
        F.to_date("ingest_ts").alias("raw_date"),
        F.hour("ingest_ts").alias("raw_hour"),
    )


def measured(parsed: DataFrame, event_type: str) -> DataFrame:
    """Events that tell a listener about each micro-batch: messages, those without required
    fields, and the longest time from a message to its ingestion."""
    lag = F.unix_timestamp("ingest_ts") - F.unix_timestamp("kafka_timestamp")
    return parsed.observe(
        f"{MEASURES}{event_type}",
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~all_present(REQUIRED_EVENT_COLUMNS)).alias("undecoded"),
        F.max(lag).alias("lag_sec"),
    )


class StreamLog(StreamingQueryListener):
    """Notes every micro-batch that read something in the lake's stream log.

    Spark calls it with what :func:`measured` observed, so batches are not read again. A batch
    repeated after a crash is noted again under another run.
    """

    def __init__(self, lake: Lake):
        self.lake = lake
        self.ended: dict[str, threading.Event] = {}

    def _end(self, run_id) -> threading.Event:
        return self.ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(event.runId)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for name, row in progress.observedMetrics.items():
            if name.startswith(MEASURES) and row["rows"]:
                entry = (
                    name.removeprefix(MEASURES), progress.batchId, progress.timestamp,
                    row["rows"], row["undecoded"], row["lag_sec"], str(progress.runId),
                )
                columns = "topic string, batch_id bigint, at string, rows bigint, undecoded bigint, lag_sec bigint, run_id string"
                noted = self.lake.spark.createDataFrame([entry], columns)
                self.lake.note("stream_log", noted.withColumn("committed_at", F.to_timestamp("at")))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(event.runId).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until everything a finished query did is noted; events come in order."""
        if not self._end(query.runId).wait(seconds):
            raise TimeoutError(f"no end of {query.runId} was reported")


def write_stream(
    parsed: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Start appending to partitioned Parquet. Every topic needs a checkpoint of its own.

    Each micro-batch is written as an ordinary append. The built-in file sink would keep a
    log of its batches beside the data: a replay under a new checkpoint starts again at batch
    0, which that log takes for already written and drops, and the log grows with every file.
    A batch repeated after a crash is a duplicate delivery like any other, and the batch
    layer removes those.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("append").partitionBy("raw_date", "raw_hour").parquet(path)

    writer = (
        parsed.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(append)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def start_streams(
    spark: SparkSession,
    open_topic,
    raw_base: str,
    checkpoint_base: str,
    only: str | None = None,
    trigger: dict | None = None,
    ingest_ts: Column | None = None,
) -> dict[str, StreamingQuery]:
    """Start one query per event type, or just ``only``. ``open_topic(type)`` gives the source.

    Add a :class:`StreamLog` to ``spark.streams`` to have their batches noted. To replay a topic, open it from the earliest offset with a new checkpoint base.
    """
    if only is not None and only not in EVENT_TYPES:
        raise ValueError(f"unknown event type {only!r}")
    return {
        event_type: write_stream(
            measured(parse_topic(open_topic(event_type), event_type, ingest_ts), event_type),
            raw_path(raw_base, event_type),
            f"{checkpoint_base}/{event_type}s",
            trigger,
        )
        for event_type in ([only] if only else EVENT_TYPES)
    }


def run_streams(spark: SparkSession, queries: dict[str, StreamingQuery]) -> None:
    """Block until any of the queries ends; a failed one raises here. The others are stopped."""
    try:
        while all(query.isActive for query in queries.values()):
            spark.streams.awaitAnyTermination()
            spark.streams.resetTerminated()
        for query in queries.values():
            if not query.isActive and query.exception() is not None:
                raise query.exception()
    finally:
        for query in queries.values():
            query.stop()
