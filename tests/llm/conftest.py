import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SF = "/root/testdata/sf0.001"
LONG = "langes Wort, " * 40_000

#: Null in every column, empty, blank and very long texts, repeated rows and ids, ties.
ODD_DOCS = [
    (1, "One two three four five six. Mail a.b@c.de or 4111 1111 1111 1111", "en", "s1", 62),
    (1, "One two three four five six. Mail a.b@c.de or 4111 1111 1111 1111", "en", "s1", 62),
    (2, "ONE TWO three four five six. Mail a.b@c.de or 4111 1111 1111 1111", "en", "s2", 62),
    (3, None, "en", "s1", None),
    (4, "", None, None, 0),
    (5, "  \n ", "de", "s1", 4),
    (6, LONG, "de", "s1", len(LONG)),
    (7, "é" * 5000, "fr", "s1", 5000),
    (8, "x", "fr", "s3", 1),
    (9, "x", "fr", "s3", 1),
    (None, "x", "fr", "s3", 1),
    (None, "only here \U0001f600 中", "fr", "s3", 16),
    (None, None, None, None, None),
]
#: Names the operators use inside.
CLASHES = [
    *("row", "id", "digest", "salt", "content", "place", "bands", "rep", "part", "found"),
    *("host", "path", "label", "quality", "rank", "size", "shard", "best", "held_out", "key"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """The odd documents with extra columns whose names clash."""
    docs = spark.createDataFrame(ODD_DOCS, SCHEMA)
    return docs.selectExpr("*", *[f"'{c}' AS {c}" for c in CLASHES]).coalesce(2)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
