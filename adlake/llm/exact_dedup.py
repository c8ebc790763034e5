"""Exact deduplication against a persistent digest index.

The index is a Parquet table bucketed and sorted by digest: (digest, keep_id). A batch is
reduced to one row per digest, matched to the index by a sort-merge join in which the index is
not shuffled, and the digests it lacked are appended. Every append adds a file to each bucket it
touches, so Spark sorts the index's narrow rows within their buckets for each join; ``rewritten``
makes one file of each bucket again, and changes their number as the index grows.

Texts are equal when identical after lower-casing A-Z; a null text is empty. Within a batch the
largest id of a text stays (a null id only if there is no other); a text that an earlier batch
brought stays with that batch's id. Rows repeated with text and id are one document written
several times: one of them stays. An empty batch appends nothing. Extra columns ride along. Very
long texts are digested whole and never stored.

Skew: rows of one text are spread by a hash of their id over SALTS parts before they meet
anything, so a text that a third of all rows share is summed in parts and joined in parts.
A repeated append finds its own digests and changes nothing, so a failed batch is run again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlake.llm.common import ascii_lower, staged, staging_path, whole_text

SALTS = 256
#: Buckets of a new index at least; on a cluster with more shuffle partitions, as many as those.
BUCKETS = 64


def digest(text: Column) -> Column:
    return F.sha2(F.encode(ascii_lower(whole_text(text)), "UTF-8"), 256)


class DigestIndex:
    """The index at ``path``, opened or begun; an opened one needs the number of buckets it was
    begun with. Without a path it lives as long as other staged files."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or staging_path(spark, "digests")
        self.buckets = buckets or max(BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} (digest STRING, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, fresh: DataFrame) -> None:
        """Adds (digest, keep_id) rows that the caller knows to be absent."""
        (
            fresh.select("digest", "keep_id")
            .repartition(self.buckets, "digest")
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .saveAsTable(self.table, path=self.path)
        )

    def rewritten(self, path: str | None = None, buckets: int | None = None) -> DigestIndex:
        """A copy with one sorted file in each bucket, with another number of them if asked."""
        copy = DigestIndex(self.spark, path, buckets or self.buckets)
        # Read as plain files: Spark would leave the shuffle out for a table already bucketed.
        copy.append(self.spark.read.schema(self.read().schema).parquet(self.path))
        return copy

    def close(self) -> None:
        """Forgets the table's name; the files stay, also for results still to be read."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def salt(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")


def sum_batch(rows: DataFrame, key: str, text: str) -> DataFrame:
    """The batch as (digest, salt, id, n), staged: one row per text and id."""
    narrow = rows.select(digest(rows[text]).alias("digest"), rows[key].cast("long").alias("id"))
    counted = narrow.groupBy("digest", "id").agg(F.count(F.lit(1)).alias("n"))
    return staged(counted.select("digest", salt(F.col("id")).alias("salt"), "id", "n"), "digests")


def settle(batch: DataFrame, index: DigestIndex) -> DataFrame:
    """(digest, salt, keep_id, group_size) for every part of every text in the batch; texts
    the index lacked are appended to it first. The index's ids win over the batch's."""
    parts = batch.groupBy("digest", "salt").agg(F.max("id").alias("id"), F.sum("n").alias("n"))
    groups = parts.groupBy("digest").agg(
        F.max("id").alias("keep_id"), F.sum("n").cast("long").alias("group_size")
    )
    known = index.read().select("digest")
    index.append(groups.join(known.hint("merge"), "digest", "left_anti"))
    kept = index.read().select("digest", "keep_id")
    whole = groups.drop("keep_id").join(kept.hint("merge"), "digest")
    return parts.select("digest", "salt").join(whole, "digest")


def classify(
    rows: DataFrame, index: DigestIndex, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per input row, dropped ones too: key, keep_id, group_size, kept, text_sha256.

    ``group_size`` counts the batch's rows of that text.
    """
    batch = sum_batch(rows, key, text)
    joined = batch.join(settle(batch, index), ["digest", "salt"])
    stays = F.col("id").eqNullSafe(F.col("keep_id"))
    copies = F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: stays & (i == 1))
    return joined.select(
        F.col("id").alias(key),
        "keep_id",
        "group_size",
        F.explode(copies).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def first_rows(
    rows: DataFrame, index: DigestIndex, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows that stay, with all their columns: one of each text that the index lacked.

    The batch's digests are appended to the index first, from narrow rows. Then a map task
    sends one row per text on (a group limit below the shuffle), however many copies there
    are, and the index keeps those whose id it holds.
    """
    settle(sum_batch(rows, key, text), index)
    packed = rows.select(
        F.struct(*[rows[c] for c in rows.columns]).alias("row"),
        digest(rows[text]).alias("digest"),
        rows[key].cast("long").alias("id"),
    )
    order = Window.partitionBy("digest").orderBy(F.col("id").desc_nulls_last())
    first = packed.withColumn("place", F.row_number().over(order)).where("place = 1")
    kept = index.read()
    same = (first["digest"] == kept["digest"]) & first["id"].eqNullSafe(kept["keep_id"])
    return first.join(kept.hint("merge"), same, "left_semi").select("row.*")
