from collections import Counter

import numpy as np
import pytest

from adlake.llm import graph, minhash


def shingle_counts(text):
    """Counts of runs of five words; a shorter text is one run."""
    words = (text or "").lower().split()
    size = min(5, len(words))
    return Counter(tuple(words[n : n + size]) for n in range(len(words) - size + 1)) if words else Counter()


def plain_similarity(x, y):
    """Probability Jaccard similarity by its definition."""
    shared = x.keys() & y.keys()
    if not shared:
        return 0.0
    if len(x) == sum(x.values()) and len(y) == sum(y.values()):  # all terms are 1 / |union|
        return len(shared) / len(x.keys() | y.keys())
    both = x.keys() | y.keys()
    return sum(1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in both) for d in shared)


def brute(docs):
    """Class of each (id, text) by comparing all pairs of texts."""
    sets = {t or "": shingle_counts(t) for _, t in docs}
    root = {t: t for t in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(sets):
        for b in list(sets)[:n]:
            if min(map(len, (sets[a], sets[b]))) >= 0.5 * max(map(len, (sets[a], sets[b]))):
                if plain_similarity(sets[a], sets[b]) >= 0.8:
                    root[find(a)] = find(b)
    least = {}
    for doc, text in docs:
        if doc is not None:
            key = find(text or "")
            least[key] = min(least.get(key, doc), doc)
    return Counter((doc, least.get(find(text or ""))) for doc, text in docs)


def test_classes_equal_all_pairs(documents):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    rows = minhash.classes(documents).collect()
    assert Counter((r.doc_id, r.class_id) for r in rows) == brute(docs)
    assert all(r.leads == (r.doc_id == r.class_id) for r in rows)


def test_shingles_and_similarity_equal_the_definition(documents):
    texts = [r.text for r in documents.limit(40).collect()] + ["a a a a a a a b", "a a a a a a b b", "x", ""]
    for text in texts:
        ids, counts = minhash.shingles(text)
        assert sorted(counts) == sorted(shingle_counts(text).values()) and len(set(ids)) == len(ids)
    for a, b in zip(texts, texts[1:]):
        want = plain_similarity(shingle_counts(a), shingle_counts(b))
        assert minhash.similarity(minhash.shingles(a), minhash.shingles(b)) == pytest.approx(want)


@pytest.fixture(scope="module")
def copies(spark):
    """A chain of texts in which neighbours are near and ends are not, some of them repeated."""
    rng = np.random.default_rng(5)
    words = [f"w{n}" for n in rng.integers(0, 10_000, 200)]
    rows = []
    for n in range(40):
        words = words.copy()
        words[(n * 37) % 200] = f"new{n}"
        rows += [(1000 - n, " ".join(words))] * (1 + n % 3)
    rows += [(5000 + n, " ".join(f"u{n}_{k}" for k in range(30))) for n in range(20)]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.mark.parametrize("block", [512, 6])
def test_chains_and_blocks(copies, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    docs = [(r.doc_id, r.text) for r in copies.collect()]
    rows = minhash.classes(copies).collect()
    assert Counter((r.doc_id, r.class_id) for r in rows) == brute(docs)
    assert minhash.leaders(copies).count() == 21


def test_one_id_on_several_texts_and_null_ids(spark):
    """Classes are of texts: an id that stands on two of them joins none, and no id loses none."""
    words = [[f"{name}{n}" for n in range(100)] for name in "abcd"]
    a, b, c, d = (" ".join(w) for w in words)
    a2, b2, c2 = (" ".join([*w[:99], "x"]) for w in words[:3])
    rows = [(1, a), (1, b), (2, a2), (3, b2), (None, c), (None, c2), (None, d), (4, d), (None, c)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = minhash.classes(df).collect()
    want = [(1, 1), (1, 1), (2, 1), (3, 1), (None, None), (None, None), (None, None), (None, 4), (4, 4)]
    assert Counter((r.doc_id, r.class_id) for r in got) == Counter(want) == brute(rows)
    # One row leads each of the four classes.
    assert Counter(r.doc_id for r in got if r.leads) == Counter([1, 1, None, 4])
    left = Counter((r.doc_id, r.text) for r in minhash.leaders(df).collect())
    assert left in [Counter([(1, a), (1, b), (4, d), (None, t)]) for t in (c, c2)]


def test_a_band_value_may_be_shared_by_very_many_texts(spark):
    texts = spark.range(140_000).selectExpr(
        "id AS node", "5L AS shingles", "array(7L, 8L, -1 - id) AS bands"
    )
    got = minhash.groups_to_compare(texts).groupBy("bucket", "leader", "parts").count().collect()
    assert [tuple(r) for r in got] == [(7, 0, -(-140_000 // minhash.BLOCK), 140_000)]


def test_a_large_group_is_sent_on_once(spark):
    """100,000 near copies: each is one row, and the leader one in each part; the rest alone meets
    other parts."""
    parts = -(-100_000 // minhash.BLOCK)
    members = spark.range(100_000).selectExpr(
        "1L AS bucket", "id AS node", "0L AS leader", f"{parts} AS parts"
    )
    rows = minhash.near_leaders(members)
    assert rows.count() == 100_000 - 1 + parts
    assert rows.where("leads").select("part").distinct().count() == parts
    # 512 texts a part on average.
    assert rows.groupBy("part").count().agg({"count": "max"}).first()[0] < 2 * minhash.BLOCK
    rest = members.where("node % 20000 = 1").select("bucket", "node")
    assert minhash.rest_pairs(members, rest).count() == 100_000 + 5 * parts


def test_long_texts_are_cut_into_parts_by_their_shingles(spark):
    texts = spark.range(10).selectExpr("id AS node", "1000000L AS shingles", "array(3L) AS bands")
    assert {r.parts for r in minhash.groups_to_compare(texts).collect()} == {10}


def test_registers_estimate_probability_jaccard():
    rng = np.random.default_rng(1)
    estimates, exact = [], []
    for n in range(60):
        base = rng.integers(0, 2**63, 80, dtype=np.uint64)
        a = np.unique(base[: 40 + n % 40]), None
        b = np.unique(base[n % 30 :]), None
        a, b = ((i, rng.integers(1, 5, len(i))) for i, _ in (a, b))
        ids = np.concatenate([a[0], b[0]])
        kept = minhash.registers(ids, np.concatenate([a[1], b[1]]), np.repeat([0, 1], [len(a[0]), len(b[0])]), 2)
        assert (kept != 0).all()
        estimates.append((kept[0] == kept[1]).mean())
        exact.append(minhash.similarity(a, b))
    assert abs(np.mean(estimates) - np.mean(exact)) < 0.02
    assert np.abs(np.array(estimates) - exact).max() < 0.2


def test_similarity_and_its_bound_by_hand():
    rng = np.random.default_rng(2)
    for _ in range(200):
        ids = [np.unique(rng.integers(0, 12, rng.integers(1, 12)).astype(np.uint64)) for _ in "ab"]
        a, b = ((i, rng.integers(1, 4, len(i))) for i in ids)
        x, y = dict(zip(a[0].tolist(), a[1].tolist())), dict(zip(b[0].tolist(), b[1].tolist()))
        want = sum(
            1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in x | y) for d in x.keys() & y.keys()
        )
        assert minhash.similarity(a, b) == pytest.approx(want)
        owner = np.repeat([0, 1], [len(a[0]), len(b[0])])
        both = [np.concatenate(p) for p in zip(a, b)]
        bound = minhash.overlaps(owner, *both, 2)[0, 1]
        assert bound >= want - 1e-6
        if both[1].max() == 1:
            assert bound == pytest.approx(want, abs=1e-6)


def test_odd_rows_and_empty(odd_docs, no_docs):
    rows = minhash.classes(odd_docs).collect()
    got = Counter((r.doc_id, r.class_id) for r in rows)
    assert got[(1, 1)] == 2 and got[(2, 1)] == 1 and got[(9, 8)] == 1
    assert got[(3, 3)] == got[(4, 3)] == got[(5, 5)] == 1
    assert {r.class_id for r in rows if r.doc_id is None} == {8, None, 3}
    out = minhash.leaders(odd_docs)
    assert out.columns == odd_docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter([1, 3, 5, 6, 7, 8, None])
    assert minhash.classes(no_docs).count() == minhash.leaders(no_docs).count() == 0


def test_components(spark):
    rng = np.random.default_rng(4)
    chain = [(n, n + 1) for n in range(0, 60)] + [(100, n) for n in range(101, 160)] + [(7, 7)]
    extra = [(int(a), int(b)) for a, b in rng.integers(200, 300, (40, 2))]
    got = {}
    edges = spark.createDataFrame(chain + extra, "a bigint, b bigint")
    for r in graph.components(edges).collect():
        assert r.id not in got
        got[r.id] = r.component
    root = {n: n for pair in chain + extra for n in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in chain + extra:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    linked = {n for a, b in chain + extra if a != b for n in (a, b)}
    assert got == {n: find(n) for n in linked}
