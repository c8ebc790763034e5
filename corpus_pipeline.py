"""The corpus pipeline: documents through filtering and deduplication into packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adlake.llm import exact_dedup, minhash, packing, pii, quality
from adlake.llm.common import current_folder, discard, run_folder, staged, table
from adlake.llm.queries import WORD_BPE


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier rejects go; null and empty texts stay or go like others
    by their site's rate."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays, that of the largest id; null is the empty text."""
    index = exact_dedup.DigestIndex(spark)
    kept = exact_dedup.first_rows(docs, index)
    index.close()
    return kept


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, that of the smallest id; texts without
    words are like no other."""
    return minhash.leaders(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; every document stays, null texts as they are."""
    return pii.mask(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences; a null text is its closing id alone."""
    return packing.pack(docs, WORD_BPE)


STAGES = [
    ("quality classifier", good),
    ("exact dedup", exact),
    ("minhash near-dedup", near),
    ("personal data", private),
    ("packing", packed),
]

#: Least squares, tokenizers and classifiers are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each one's result is written to the shared folder and read by the next.

    What a stage stages on its way goes once its result is written, and that result once the
    next one's is. A run that fails is begun again.
    """
    docs, before, folder = table(spark, sf_dir, "documents"), None, current_folder(spark)
    for name, stage in STAGES[:-1]:
        with run_folder(spark):
            docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"), folder=folder)
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
