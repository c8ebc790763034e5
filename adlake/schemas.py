"""Table contracts. Schemas are declared here and never inferred."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructField, StructType

EVENT_TYPES = ("impression", "click", "conversion")

TEXT, INT, BIGINT, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
DATE, TIMESTAMP, BINARY = T.DateType(), T.TimestampType(), T.BinaryType()

EVENT = [
    StructField("eid", TEXT, False),
    StructField("uid", TEXT, False),
    StructField("timestamp", BIGINT, False),
    StructField("event_time", TEXT, True),
    StructField("event_type", TEXT, False),
    StructField("campaign", INT, True),
]

COST = StructField("cost", DOUBLE, True)

ARRIVAL = [
    StructField("kafka_partition", INT, True),
    StructField("kafka_offset", BIGINT, True),
    StructField("kafka_timestamp", TIMESTAMP, True),
    StructField("ingest_ts", TIMESTAMP, True),
    StructField("raw_date", DATE, True),
    StructField("raw_hour", INT, True),
]

# JSON payload of one topic message; only impressions carry a cost.
PAYLOADS = {
    "impression": StructType([*EVENT, COST]),
    "click": StructType(EVENT),
    "conversion": StructType(EVENT),
}

# Raw layer: payload plus arrival metadata.
RAW = {
    "impression": StructType([*EVENT, COST, *ARRIVAL]),
    "click": StructType([*EVENT, *ARRIVAL]),
    "conversion": StructType([*EVENT, *ARRIVAL]),
}

SILVER = StructType(
    [
        StructField("event_id", TEXT, False, {"comment": "impression id shared by all three event types"}),
        StructField("event_date", DATE, False, {"comment": "UTC day of the impression; partition column"}),
        StructField("event_hour", INT, True, {"comment": "UTC hour of the impression"}),
        StructField("event_time", TIMESTAMP, True, {"comment": "instant of the impression"}),
        StructField("uid", TEXT, False, {"comment": "user"}),
        StructField("campaign", INT, True, {"comment": "campaign"}),
        StructField("click", INT, True, {"comment": "1 when a click is attributed, else 0"}),
        StructField("conversion", INT, True, {"comment": "1 when a conversion is attributed, else 0"}),
        StructField("conversion_timestamp", BIGINT, True, {"comment": "unix seconds; -1 without a conversion"}),
        StructField("conversion_delay_sec", BIGINT, True, {"comment": "seconds from impression to conversion; -1 without one"}),
        StructField("cost", DOUBLE, True, {"comment": "cost of the impression"}),
        StructField("producer_to_broker_sec", BIGINT, True, {"comment": "broker time minus event time"}),
        StructField("broker_to_ingest_sec", BIGINT, True, {"comment": "ingest time minus broker time"}),
        StructField("end_to_end_latency_sec", BIGINT, True, {"comment": "ingest time minus event time"}),
        StructField("updated_at", TIMESTAMP, True, {"comment": "time of the last write to the row"}),
    ]
)

GOLD = StructType(
    [
        StructField("summary_date", DATE, False, {"comment": "day of the impressions; partition column"}),
        StructField("campaign", INT, False, {"comment": "campaign"}),
        StructField("impressions", BIGINT, True, {"comment": "rows"}),
        StructField("clicks", BIGINT, True, {"comment": "attributed clicks"}),
        StructField("conversions", BIGINT, True, {"comment": "attributed conversions"}),
        StructField("unique_users", BIGINT, True, {"comment": "distinct users"}),
        StructField("converting_users", BIGINT, True, {"comment": "distinct users with a conversion"}),
        StructField("total_cost", DOUBLE, True, {"comment": "summed cost"}),
        StructField("ctr", DOUBLE, True, {"comment": "clicks per 100 impressions"}),
        StructField("cvr", DOUBLE, True, {"comment": "conversions per 100 clicks; NULL without clicks"}),
        StructField("cpc", DOUBLE, True, {"comment": "cost per click; NULL without clicks"}),
        StructField("cpa", DOUBLE, True, {"comment": "cost per conversion; NULL without conversions"}),
        StructField("cpm", DOUBLE, True, {"comment": "cost per 1000 impressions"}),
        StructField("click_through_conversions", BIGINT, True, {"comment": "conversions of clicked impressions"}),
        StructField("view_through_conversions", BIGINT, True, {"comment": "conversions of impressions not clicked"}),
        StructField("avg_conversion_delay_sec", DOUBLE, True, {"comment": "mean delay of attributed conversions"}),
        StructField("frequency", DOUBLE, True, {"comment": "impressions per user"}),
        StructField("updated_at", TIMESTAMP, True, {"comment": "time of the write"}),
    ]
)

RUN_LOG = StructType(
    [
        StructField("layer", TEXT, False),
        StructField("commit_id", BIGINT, False, {"comment": "number of the run within its layer"}),
        StructField("parent_id", BIGINT, True, {"comment": "number of the run before"}),
        StructField("committed_at", TIMESTAMP, False, {"comment": "time of the run"}),
        StructField("operation", TEXT, False),
        StructField("records", BIGINT, True, {"comment": "rows added or changed"}),
    ]
)

# What a micro-batch of a stream did.
STREAM_LOG = StructType(
    [
        StructField("topic", TEXT, False),
        StructField("batch_id", BIGINT, False),
        StructField("committed_at", TIMESTAMP, False, {"comment": "time the batch was triggered"}),
        StructField("rows", BIGINT, True, {"comment": "messages read"}),
        StructField("undecoded", BIGINT, True, {"comment": "messages without their required fields"}),
        StructField("lag_sec", BIGINT, True, {"comment": "seconds from the oldest message to its ingestion"}),
        StructField("run_id", TEXT, True, {"comment": "run of the streaming query"}),
    ]
)

DAY_SUMMARY = StructType(
    [
        StructField("event_date", DATE, True),
        StructField("row_count", BIGINT, True),
        StructField("clicks", BIGINT, True),
        StructField("conversions", BIGINT, True),
        StructField("last_update", TIMESTAMP, True),
    ]
)

DAY_NOTE = StructType(
    [*DAY_SUMMARY, StructField("noted_at", BIGINT, False, {"comment": "microseconds; the latest note counts"})]
)

# Sketches per day and campaign that add up over days, which distinct counts and percentiles do not.
SKETCHES = StructType(
    [
        StructField("summary_date", DATE, False, {"comment": "day of the impressions; partition column"}),
        StructField("campaign", INT, False, {"comment": "campaign"}),
        StructField("users", BINARY, True, {"comment": "theta sketch of users"}),
        StructField("converting_users", BINARY, True, {"comment": "theta sketch of users with a conversion"}),
        StructField("conversion_delay_sec", BINARY, True, {"comment": "quantile sketch of delays"}),
        StructField("end_to_end_latency_sec", BINARY, True, {"comment": "quantile sketch of latencies"}),
    ]
)

# Part of a Bloom filter: the ids a batch brought to a day whose hash falls into one bucket.
ID_FILTER = StructType(
    [
        StructField("event_date", DATE, True),
        StructField("buckets", INT, False, {"comment": "buckets of the day's filter"}),
        StructField("bucket", INT, False),
        StructField("first_id", TEXT, True),
        StructField("last_id", TEXT, True),
        StructField("bits", BINARY, False, {"comment": "bitmap of 32,768 positions"}),
    ]
)

LAYOUT = StructType(
    [
        StructField("layer", TEXT, False),
        StructField("event_date", DATE, False),
        StructField("layout", TEXT, False),
        StructField("files", BIGINT, False, {"comment": "files of the day when it was rewritten"}),
        StructField("bytes", BIGINT, False, {"comment": "their bytes"}),
    ]
)

# One JSON line per message in the file form of a topic.
TOPIC_FILE = StructType(
    [
        StructField("value", TEXT, True),
        StructField("partition", INT, True),
        StructField("offset", BIGINT, True),
        StructField("timestamp", TIMESTAMP, True),
    ]
)

# Wide attribution row: an impression with its click and conversion on one line.
WIDE = StructType(
    [
        StructField("timestamp", BIGINT, True),
        StructField("uid", TEXT, True),
        StructField("campaign", INT, True),
        StructField("click", INT, True),
        StructField("conversion", INT, True),
        StructField("conversion_id", BIGINT, True),
        StructField("conversion_timestamp", BIGINT, True),
        StructField("cost", DOUBLE, True),
    ]
)

REQUIRED_EVENT_COLUMNS = ("eid", "uid", "timestamp")


def all_present(columns) -> Column:
    return reduce(and_, (F.col(name).isNotNull() for name in columns))


def keyed(events: DataFrame) -> DataFrame:
    """Events that carry every required field.

    Undecodable messages decode to all-NULL rows. Left in, they would share one NULL key and
    meet in a single shuffle partition.
    """
    return events.where(all_present(REQUIRED_EVENT_COLUMNS))


def quarantined(events: DataFrame) -> DataFrame:
    """The complement of :func:`keyed`."""
    return events.where(~all_present(REQUIRED_EVENT_COLUMNS))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in contract order and type, with the contract's comments.

    NULL in a NOT NULL column fails the query when the row is computed, so no separate
    checking pass over the data is needed.
    """

    def checked(field: T.StructField) -> Column:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            message = f"NULL in required column {field.name}"
            value = F.coalesce(value, F.raise_error(F.lit(message)).cast(field.dataType))
        return value.alias(field.name, metadata=field.metadata)

    return df.select(*(checked(field) for field in schema))


def nullable(schema: T.StructType) -> T.StructType:
    """The schema for reading: a file may break the contract, and a declared NOT NULL would
    make Spark skip the very tests that find such rows."""
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema])


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
