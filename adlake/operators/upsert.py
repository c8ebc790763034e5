"""Upserts as joins. Each function returns rows; the table layer writes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions.columns import flag
from adlake.operators.dedup import unique_by
from adlake.operators.joins import batch_side


def insert_absent(
    target: DataFrame, staged: DataFrame, key: str, count: int | None = None
) -> DataFrame:
    """The staged rows whose key the target does not hold in any partition.

    The target is read for its key column only and first reduced to the keys the batch also
    has. A batch whose ``count`` of rows is small is then broadcast and the table's keys never
    shuffle; asking for the anti join directly would oblige Spark to build on the table.
    """
    batch_keys = batch_side(staged.select(F.col(key).alias("_batch_key")), count)
    held = target.select(key).join(batch_keys, F.col(key) == F.col("_batch_key"), "left_semi")
    return staged.join(batch_side(held, count), key, "left_anti")


def pending_updates(click_matches: DataFrame, conversion_matches: DataFrame) -> DataFrame:
    """Both kinds of matches as one row per impression.

    ``changes`` tells whether applying the row would alter the stored impression, so a
    repeated run finds nothing to rewrite. Several clicks, or several conversions, of one
    impression fail the query: values of different rows must not be mixed.
    """
    nothing = F.lit(None).cast("bigint")
    keys = ["event_id", "event_date"]
    clicked = click_matches.select(
        *keys,
        F.lit(1).alias("_click"),
        nothing.alias("_conv_ts"),
        nothing.alias("_conv_delay"),
        flag(F.col("click") == 0).alias("_change"),
    )
    converted = conversion_matches.select(
        *keys,
        F.lit(0).alias("_click"),
        F.col("match_ts").alias("_conv_ts"),
        F.col("match_delay_sec").alias("_conv_delay"),
        flag(F.col("conversion") == 0).alias("_change"),
    )
    single = (F.sum("_click") <= 1) & (F.count("_conv_ts") <= 1)
    message = f"several source rows for one key {tuple(keys)}"
    return (
        clicked.unionByName(converted)
        .groupBy(*keys)
        .agg(
            F.when(single, F.max("_click")).otherwise(
                F.raise_error(F.lit(message)).cast("int")
            ).alias("new_click"),
            F.max("_conv_ts").alias("new_conversion_timestamp"),
            F.max("_conv_delay").alias("new_conversion_delay_sec"),
            (F.max("_change") == 1).alias("changes"),
        )
    )


def apply_updates(
    target: DataFrame, updates: DataFrame, now: Column, count: int | None = None
) -> DataFrame:
    """``target`` after clicks and conversions of :func:`pending_updates`, in one pass.

    ``count`` is the number of updates, where it is known.
    """
    changes = batch_side(updates.drop("changes"), count)
    joined = target.join(changes, ["event_id", "event_date"], "left")
    clicks = (F.col("new_click") == 1) & (F.col("click") == 0)
    converts = F.col("new_conversion_timestamp").isNotNull() & (F.col("conversion") == 0)
    new_values = {
        "click": F.when(clicks, 1),
        "conversion": F.when(converts, 1),
        "conversion_timestamp": F.when(converts, F.col("new_conversion_timestamp")),
        "conversion_delay_sec": F.when(converts, F.col("new_conversion_delay_sec")),
        "updated_at": F.when(clicks | converts, now),
    }
    return joined.select(
        *(
            F.coalesce(new_values[name], F.col(name)).alias(name) if name in new_values else name
            for name in target.columns
        )
    )


def upsert(
    target: DataFrame, staged: DataFrame, keys: list[str], grouped: bool = False
) -> DataFrame:
    """Staged rows replace target rows with the same key; all other target rows stay.

    A repeated staged key fails the query; rows just ``grouped`` by the keys need no check.
    """
    staged = staged if grouped else unique_by(staged, keys)
    kept = target.join(staged.select(*keys), keys, "left_anti")
    return kept.unionByName(staged.select(*target.columns))


def update_where(df: DataFrame, predicate: Column, assignments: dict[str, Column]) -> DataFrame:
    """SQL ``UPDATE``: new values where the predicate is true."""
    return _assign(df, df.columns, predicate, assignments)


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """SQL ``DELETE``: rows where the predicate is false or NULL stay."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def _assign(df: DataFrame, columns: list[str], applies: Column, values: dict) -> DataFrame:
    return df.select(
        *(
            F.when(applies, values[name]).otherwise(F.col(name)).alias(name)
            if name in values
            else F.col(name)
            for name in columns
        )
    )
