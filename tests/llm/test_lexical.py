"""Ranked search against scoring every document, and the bounds it relies on."""

import math
import random
import re
from collections import Counter

import numpy as np
from compare import connect, duck_rows, spark_rows
from conftest import SF

from adlake.llm import lexical
from adlake.llm.oracles import OP12

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOW))


def plain(docs, items, k):
    counted = [(doc, Counter(words(text))) for doc, text in docs]
    counted = [(doc, c) for doc, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in sorted(set(items), key=str):
        scored = []
        for doc, c in counted:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // total
            score = 0
            for t in set(words(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=str)


def searched(spark, docs, items, k):
    docs = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], "doc_id bigint, text string, n string, item int, rank int")
    items = spark.createDataFrame([(*i, 7) for i in items], "item_id bigint, text string, score int")
    rows = lexical.search(docs.repartition(3), items, k).select("item_id", "rank", "doc_id", "score")
    return sorted((tuple(r) for r in rows.collect()), key=str)


def test_terms_split_at_ascii_separators_only():
    text = "Ünï-Code x y MIXed_9 9a \x7f z"
    assert [w.decode() for part in lexical.terms_of(text.encode()) for w in part] == words(text)


def test_long_texts_are_cut_at_separators(monkeypatch):
    monkeypatch.setattr(lexical, "SLICE_BYTES", 7)
    text = "alpha beta-gamma  deltadeltadelta é" * 5
    assert [w.decode() for part in lexical.terms_of(text.encode()) for w in part] == words(text)


def test_equals_scoring_every_document(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SEGMENT_DOCS", 16)
    rng = random.Random(3)
    vocabulary = [f"w{n}" for n in range(40)]
    docs = [(n, " ".join(rng.choices(vocabulary, [1 / (r + 1) for r in range(40)], k=rng.randint(1, 60)))) for n in range(300)]
    docs += [(n % 7, docs[0][1]) for n in range(60)]  # many equal rows and ties
    docs += [(None, docs[1][1]), (None, None), (500, None), (501, ""), (502, "--- ..."), (503, "w1 " * 20_000)]
    items = [(n, " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for n in range(12)]
    items += [(3, "w1 w2 w2"), (3, "w1 w2 w2"), (None, "w3 w4"), (90, None), (91, "!!"), (92, "absent")]
    for k in (1, 5, 50):
        assert searched(spark, docs, items, k) == plain(docs, items, k)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs = [(n, f"a{n % 3} b{n % 5} c") for n in range(40)]
    items = [(n, f"a{n} b{n}") for n in range(3)]
    whole = searched(spark, docs, items, 5)
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 20)
    assert searched(spark, docs, items, 5) == whole == plain(docs, items, 5)


def test_empty_tables(spark):
    assert searched(spark, [(1, "a")], [(1, None)], 5) == []
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert lexical.search(docs, items).count() == 0
    assert lexical.search(docs, items.where("false")).count() == 0


def test_pairs_tighten_bounds_and_stay_above_scores():
    """b(i) is at most the sum of single maxima and at least every document's rest."""
    rng = np.random.default_rng(1)
    for _ in range(200):
        impacts = rng.integers(1, 100, (30, 6)) * (rng.random((30, 6)) < 0.4)
        tops = impacts.max(axis=0)
        both = [impacts[(impacts[:, i] > 0) & (impacts[:, i + 1] > 0)] for i in range(5)]
        joint = np.array([int(b[:, [i, i + 1]].sum(axis=1).max()) if len(b) else 0 for i, b in enumerate(both)])
        bound = lexical.bounds(tops, joint)
        rest = np.cumsum(impacts[:, ::-1], axis=1)[:, ::-1].max(axis=0)
        assert (bound[:-1] >= rest).all() and (bound[:-1] <= np.cumsum(tops[::-1])[::-1]).all()
    tight = lexical.bounds(np.array([10, 9]), np.array([12]))
    assert tight[0] == 12


def test_equals_the_sql(spark):
    from adlake.llm.queries import QUERIES

    mine = spark_rows(QUERIES["op12_pair_maxscore"](spark, SF))
    assert mine == duck_rows(connect(SF), OP12)
