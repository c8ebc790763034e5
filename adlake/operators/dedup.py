"""Duplicate removal."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Earliest arrival wins. Offset and partition settle equal ingest times, so the choice does
# not depend on how rows happen to be spread.
ARRIVAL_ORDER = ("ingest_ts", "kafka_offset", "kafka_partition")


def first_per_key(df: DataFrame, keys: list[str], order=ARRIVAL_ORDER) -> DataFrame:
    """One row per key: the first in ``order``.

    Spark plans a rank filter of one with a group limit before the shuffle, so every map
    task sends at most one row per key. A key that holds a third of all rows costs its
    reducer one row per map task, not a third of the data.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.select("*", position.alias("_position")).where("_position = 1").drop("_position")


def unique_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """The same rows, failing the query if a key occurs twice.

    A join would silently fan out on such a key. The check is part of the plan: it
    aggregates on the join keys, so the join that follows reuses its shuffle, and repeated
    keys collapse before it.
    """
    rest = [name for name in df.columns if name not in keys]
    packed = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_copies"),
        F.first(F.struct(*rest)).alias("_row"),
    )
    message = f"several source rows for one key {tuple(keys)}"
    checked = F.when(F.col("_copies") > 1, F.raise_error(F.lit(message))).otherwise(F.col("_row"))
    return packed.select(*keys, checked.alias("_row")).select(*keys, "_row.*").select(*df.columns)

