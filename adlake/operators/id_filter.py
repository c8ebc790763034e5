"""Bloom filters of the ids stored under each day, made and probed with built-in functions.

A filter consists of bitmaps of 4 KB. An id falls into one of the day's bitmaps by its hash and
sets ``HASHES`` of its bits, so a probe needs one bitmap. About ``BITS`` bits an id keep a wrong
hit below one in a hundred thousand. Filters only gain ids: each batch adds bitmaps of its own, and an id may
be under any of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.operators.joins import batch_side

BITMAP = 32_768
BITS, HASHES = 32, 12


def _start(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITMAP)).cast("int")


def _step(key: Column) -> Column:
    """Odd, so that the positions of an id differ."""
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(BITMAP)).cast("int").bitwiseOR(F.lit(1))


def positions(start: Column, step: Column) -> list[Column]:
    """Double hashing with a growing extra step."""
    return [
        F.pmod(start + step * F.lit(n) + F.lit((n**3 - n) // 6), F.lit(BITMAP)) for n in range(HASHES)
    ]


def bucket(key: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(2)), buckets).cast("int")


def build(rows: DataFrame, key: str, day: str) -> DataFrame:
    """(day, buckets, bucket, first_id, last_id, bits) of the rows' ids.

    The number of a day's bitmaps is the power of two its rows need, so there are few numbers.
    Bitmaps are combined before their shuffle, and a large day's are as many groups.
    """
    sizes = rows.groupBy(F.col(day).alias("_day")).agg(F.count(F.lit(1)).alias("n"))
    needed = F.greatest(F.lit(1.0), F.col("n") * F.lit(BITS / BITMAP))
    sizes = sizes.select("_day", F.pow(F.lit(2), F.ceil(F.log2(needed))).cast("int").alias("buckets"))
    placed = rows.select(F.col(key).alias("id"), F.col(day).alias(day)).join(
        sizes, F.col(day).eqNullSafe(F.col("_day"))
    )
    bits = F.explode(F.array(*positions(_start(F.col("id")), _step(F.col("id"))))).alias("at")
    marked = placed.select(day, "buckets", bucket(F.col("id"), F.col("buckets")).alias("bucket"), "id", bits)
    return marked.groupBy(day, "buckets", "bucket").agg(
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.bitmap_construct_agg("at").alias("bits"),
    )


def holds(bits: Column, at: Column) -> Column:
    """Whether a bitmap has the bit at a position."""
    byte = F.conv(F.hex(F.substring(bits, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, at % 8) == 1


def probe(
    filters: DataFrame, rows: DataFrame, key: str, day: str, count: int | None = None
) -> DataFrame:
    """The days that may hold an id of ``rows``, ``count`` of them where that is known.

    An id meets one bitmap per day and batch, and only where it lies between the bitmap's
    first and last id.
    """
    kinds = sorted(r[0] for r in filters.select("buckets").distinct().collect())  # powers of two
    if not kinds:
        return filters.select(day)
    ids = rows.select(F.col(key).alias("id"), F.explode(F.array(*map(F.lit, kinds))).alias("of"))
    wanted = ids.select(
        "id", "of", bucket(F.col("id"), F.col("of")).alias("in"),
        _start(F.col("id")).alias("start"), _step(F.col("id")).alias("step"),
    )
    probes = None if count is None else count * len(kinds)
    same = (F.col("of") == F.col("buckets")) & (F.col("in") == F.col("bucket"))
    met = batch_side(wanted, probes).join(filters, same)
    hit = F.col("id").between(F.col("first_id"), F.col("last_id"))
    for at in positions(F.col("start"), F.col("step")):
        hit = hit & holds(F.col("bits"), at)
    return met.where(hit).select(day).distinct()
