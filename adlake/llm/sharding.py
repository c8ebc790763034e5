"""Weighted rendezvous sharding of stable record keys.

Every (key, shard) pair gets a hash; a record goes to the shard with the highest score
``-weight / ln(u)``, where u in (0, 1) comes from that hash. A shard's score for a key does not
depend on the other shards, so a new shard takes exactly the records it wins and moves no
other; a removed one gives up only its own. Shares follow the weights.

Nulls: a null key is hashed like a value of its own; a null text has no bytes. Repeated keys
go to the same shard. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import numbered

ROW_OVERHEAD = 16


def unit(key: Column, shard: int) -> Column:
    """A hash of (key, shard) as a double strictly between 0 and 1."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11)
    return (bits.cast("double") + 0.5) / float(1 << 53)


def score(key: Column, shard: int, weight: float) -> Column:
    return F.lit(-float(weight)) / F.log(unit(key, shard))


def winner(key: Column, weights: Sequence[float]) -> Column:
    """Struct (score, shard) of the best shard; the lower number wins a tie. A shard of
    weight 0 takes nothing."""
    bids = [
        F.struct(score(key, n, w).alias("score"), F.lit(-n).alias("shard"))
        for n, w in enumerate(weights)
        if w > 0
    ]
    best = F.greatest(*bids) if len(bids) > 1 else bids[0]
    return F.struct(best["score"].alias("score"), (-best["shard"]).alias("shard"))


def assign(
    records: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    weights: Sequence[float] = (1.0,) * 40,
    grown_weight: float = 1.0,
) -> DataFrame:
    """One row per record: key, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the text's UTF-8 bytes plus ROW_OVERHEAD. ``grown_shard`` is the shard with
    one more shard of ``grown_weight``. ``slot`` numbers a shard's records from 0.
    """
    if not any(w > 0 for w in weights):
        raise ValueError("at least one shard needs a positive weight")
    content = F.coalesce(records[text].cast("string"), F.lit(""))
    bids = records.select(
        records[key].alias(key),
        (F.octet_length(content) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(F.encode(content, "UTF-8")).alias("text_crc32"),
        winner(records[key], weights).alias("best"),
    )
    grown = F.when(
        score(F.col(key), len(weights), grown_weight) > F.col("best.score"), len(weights)
    ).otherwise(F.col("best.shard"))
    placed = bids.select(
        key,
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        F.col("best.shard").cast("int").alias("shard"),
        (grown if grown_weight > 0 else F.col("best.shard")).cast("int").alias("grown_shard"),
    )
    # One id may stand on all rows, so a shard may hold as many; counting reads no column.
    return numbered(placed, ["shard"], [key, "text_crc32", "size"], "slot", records.count()).select(
        key, "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
