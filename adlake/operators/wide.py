"""Wide attribution rows split into event streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions.columns import iso_utc
from adlake.schemas import PAYLOADS
from adlake.session import scratch_path

# Position bits of monotonically_increasing_id: the partition sits above them.
_POSITION_BITS = 33
CLICK_DELAY_MAX = 30


def number_rows(
    rows: DataFrame, order: list[str], partitions: int | None = None, path: str | None = None
) -> DataFrame:
    """``row_index`` 0, 1, 2, ... over the whole frame in the given order.

    Rows are range-partitioned and sorted, and every partition numbers its own rows. The
    result is kept as a table, at ``path`` if the caller wants to delete it afterwards, so that
    numbers cannot change on a retry. Adding up partition
    sizes then takes one row per partition. Nothing is sorted in a single task.
    """
    spark = rows.sparkSession
    by = [F.col(name) for name in order]
    placed = rows.repartitionByRange(partitions, *by) if partitions else rows.repartitionByRange(*by)
    path = path or scratch_path(spark, "numbered")
    placed.sortWithinPartitions(*by).withColumn(
        "_position", F.monotonically_increasing_id()
    ).write.parquet(path)

    kept = spark.read.parquet(path)
    part = F.shiftright("_position", _POSITION_BITS)
    sizes = kept.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    # One row per shuffle partition of the write above.
    ends, total = [], 0
    for row in sizes.orderBy("_part").collect():
        ends.append((row["_part"], total))
        total += row["_size"]
    offsets = spark.createDataFrame(ends, "_part bigint, _offset bigint")
    within_part = F.col("_position").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        kept.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn("row_index", F.col("_offset") + within_part)
        .select("row_index", *rows.columns)
    )


def first_conversions(numbered: DataFrame) -> DataFrame:
    """The conversion rows to keep: the first of each ``conversion_id``.

    Aggregates before the shuffle, so an id repeated on a third of all rows sends one row
    per map task.
    """
    payload = F.struct(*(c for c in numbered.columns if c != "conversion_id"))
    return (
        numbered.where(F.col("conversion") == 1)
        .groupBy("conversion_id")
        .agg(F.min_by(payload, F.col("row_index")).alias("_first"))
        .select("conversion_id", "_first.*")
        .select(*numbered.columns)
    )


def origin(numbered: DataFrame) -> int | None:
    """The first row's time: the origin of the remapped clock. One number, read once."""
    return numbered.agg(F.min_by("timestamp", "row_index")).first()[0]


def remap(unix: Column, base: int | None, real_start: float, speed: float) -> Column:
    """``real_start + (unix - base) / speed`` as whole seconds, rounded down."""
    moved = F.lit(float(real_start)) + (unix - F.lit(base)) / F.lit(float(speed))
    return F.floor(moved).cast("bigint")


def click_delay(eid: Column) -> Column:
    """1 to 30 seconds, spread evenly and always the same for one impression."""
    digits = F.conv(F.substring(F.md5(eid), 1, 8), 16, 10).cast("bigint")
    return F.lit(1) + F.pmod(digits, F.lit(CLICK_DELAY_MAX))


def time_remap(numbered: DataFrame, real_start: float, speed: float) -> DataFrame:
    """Adds ``real_ts``, each row's time on the remapped clock."""
    moved = remap(F.col("timestamp"), origin(numbered), real_start, speed)
    return numbered.withColumn("real_ts", moved)


def split_wide_events(numbered: DataFrame, real_start: float, speed: float) -> DataFrame:
    """Impression, click and conversion events of numbered wide rows.

    Every row shows an impression; clicks follow it by a few seconds; conversions happen at
    their own time, once per conversion id. Only the conversion rows are shuffled.
    """
    eid = F.format_string("evt_%08d", "row_index")
    base = origin(numbered)

    def events(rows: DataFrame, event_type: str, unix: Column, cost: Column) -> DataFrame:
        return rows.select(
            eid.alias("eid"),
            "uid",
            remap(unix, base, real_start, speed).alias("timestamp"),
            F.lit(event_type).alias("event_type"),
            "campaign",
            cost.alias("cost"),
        ).withColumn("event_time", iso_utc("timestamp"))

    no_cost = F.lit(None).cast("double")
    shown = events(numbered, "impression", F.col("timestamp"), F.coalesce("cost", F.lit(0.0)))
    clicked = events(
        numbered.where(F.col("click") == 1),
        "click",
        F.col("timestamp") + click_delay(eid),
        no_cost,
    )
    converted = events(
        first_conversions(numbered), "conversion", F.col("conversion_timestamp"), no_cost
    )
    return shown.unionByName(clicked).unionByName(converted).select(*PAYLOADS["impression"].names)
