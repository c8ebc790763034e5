"""Event frames derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake import schemas

from adlake.functions.columns import instant, iso_utc
from adlake.schemas import RAW, WIDE

# How the table's event types map to ours.
EVENT_TYPE_OF = {"view": "impression", "click": "click", "purchase": "conversion"}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def raw_events(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    """Raw-layer rows of one type. The type filter reaches the Parquet scan."""
    source = next(name for name, ours in EVENT_TYPE_OF.items() if ours == event_type)
    events = load(spark, sf_dir, "events").where(F.col("event_type") == source)
    k = F.get_json_object("props", "$.k").cast("int")
    broker = F.col("timestamp") + F.col("event_id") % 7
    ingest = broker + (F.col("event_id") * 37) % 601
    return (
        events.withColumn("timestamp", F.unix_timestamp("ts"))
        .select(
            F.concat_ws("_", "user_id", k).alias("eid"),
            F.col("user_id").cast("string").alias("uid"),
            "timestamp",
            iso_utc("timestamp").alias("event_time"),
            F.lit(event_type).alias("event_type"),
            (k % 10).alias("campaign"),
            F.col("value").alias("cost"),
            F.pmod("user_id", F.lit(3)).cast("int").alias("kafka_partition"),
            F.col("event_id").alias("kafka_offset"),
            instant(broker).alias("kafka_timestamp"),
            instant(ingest).alias("ingest_ts"),
        )
        .withColumn("raw_date", F.to_date("ingest_ts"))
        .withColumn("raw_hour", F.hour("ingest_ts"))
        .select(*RAW[event_type].names)
    )


def topic_messages(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    """The same events as topic messages with a JSON value."""
    raw = raw_events(spark, sf_dir, event_type)
    payload = [
        name
        for name in RAW[event_type].names
        if not name.startswith(("kafka_", "raw_")) and name != "ingest_ts"
    ]
    return raw.select(
        F.to_json(F.struct(*payload)).alias("value"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
    )


def order_impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as impressions, for joins with many more distinct ids."""
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("eid"),
        F.col("o_custkey").cast("string").alias("uid"),
        F.unix_timestamp("o_orderdate").alias("timestamp"),
        (F.col("o_custkey") % 100).cast("int").alias("campaign"),
        F.col("o_totalprice").alias("cost"),
        instant(F.unix_timestamp("o_orderdate")).alias("ingest_ts"),
        F.col("o_orderkey").alias("kafka_offset"),
        F.lit(0).alias("kafka_partition"),
    )


def line_item_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as the later events of their order."""
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("eid"),
        F.unix_timestamp("l_shipdate").alias("timestamp"),
        instant(F.unix_timestamp("l_shipdate")).alias("ingest_ts"),
        F.col("l_linenumber").cast("bigint").alias("kafka_offset"),
        F.col("l_partkey").alias("kafka_partition"),
    )


def wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide attribution rows, one per view, click or purchase event.

    Times are seconds since 2024-01-01; ``conversion_id`` repeats across rows.
    """
    events = load(spark, sf_dir, "events").where(F.col("event_type").isin(*EVENT_TYPE_OF))
    k = F.get_json_object("props", "$.k").cast("int")
    seconds = F.unix_timestamp("ts") - F.lit(1704067200)
    return (
        events.withColumn("k", k)
        .withColumn("timestamp", seconds)
        .select(
            "event_id",
            "timestamp",
            F.col("user_id").cast("string").alias("uid"),
            (F.col("k") % 10).alias("campaign"),
            F.when(F.col("k") % 3 == 0, 1).otherwise(0).alias("click"),
            F.when(F.col("k") % 4 == 0, 1).otherwise(0).alias("conversion"),
            F.when(F.col("k") % 4 == 0, F.col("user_id")).otherwise(-1).alias("conversion_id"),
            F.when(F.col("k") % 4 == 0, F.col("timestamp") + F.col("k") * 3600)
            .otherwise(-1)
            .alias("conversion_timestamp"),
            F.when(F.col("k") % 5 != 0, F.col("value")).alias("cost"),
        )
        .select("event_id", *WIDE.names)
    )


def no_events(spark: SparkSession) -> DataFrame:
    """An empty batch of clicks."""
    return schemas.empty(spark, schemas.RAW["click"])
