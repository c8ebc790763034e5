import struct
import zlib
from collections import Counter, defaultdict
from math import log

import duckdb
import pytest
import xxhash
from compare import duck_rows, spark_rows

from adlake.llm import sharding
from adlake.llm.oracles import op2


def brute_shard(doc_id, weights):
    """xxhash64 of the id and the shard number, chained as Spark does it."""
    seed = 42 if doc_id is None else xxhash.xxh64_intdigest(struct.pack("<q", doc_id), 42)
    scores = []
    for n, w in enumerate(weights):
        bits = xxhash.xxh64_intdigest(struct.pack("<i", n), seed) >> 11
        scores.append(-w / log((bits + 0.5) / 2**53) if w else -1)
    return scores.index(max(scores))


def test_every_row_goes_where_brute_force_puts_it(documents):
    rows = sharding.assign(documents).collect()
    assert len(rows) == documents.count()
    for r in rows:
        assert r.shard == brute_shard(r.doc_id, [1.0] * 40)
        assert r.grown_shard == brute_shard(r.doc_id, [1.0] * 41)
        assert r.grown_shard in (r.shard, 40)
    texts = {r.doc_id: r.text.encode() for r in documents.collect()}
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id]) for r in rows)
    assert all(r.size == len(texts[r.doc_id]) + 16 for r in rows)


def test_slots_are_gapless_and_odd_rows_stay(odd_docs):
    rows = sharding.assign(odd_docs, weights=[1.0, 2.0, 0.0]).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.shard == brute_shard(r.doc_id, [1.0, 2.0, 0.0])
    assert len(rows) == 13 and 2 not in slots
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sum(r.size == 16 for r in rows) == 3


def test_shares_follow_weights(spark):
    ids = spark.range(20_000).selectExpr("id AS doc_id", "'' AS text")
    counts = Counter(r.shard for r in sharding.assign(ids, weights=[3.0, 1.0]).collect())
    assert counts[0] / 20_000 == pytest.approx(0.75, abs=0.02)


def test_empty(no_docs):
    assert sharding.assign(no_docs).count() == 0
    with pytest.raises(ValueError):
        sharding.assign(no_docs, weights=[0.0])


def test_sql_gives_the_same_for_odd_rows(odd_docs):
    with duckdb.connect() as con:
        con.register("documents", odd_docs.select("doc_id", "text").toArrow())
        wanted = duck_rows(con, op2())
    assert spark_rows(sharding.assign(odd_docs)) == wanted
