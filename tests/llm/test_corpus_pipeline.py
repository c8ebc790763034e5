import pytest

import corpus_pipeline
from adlake.llm import exact_dedup, minhash, packing, pii, quality
from adlake.llm.common import LOWER, UPPER, run_folder, staged
from adlake.sources import files

SF = "/root/testdata/sf0.001"


def texts_of(df):
    return {r.doc_id: r.text for r in df.collect()}


@pytest.fixture(scope="module")
def steps(spark):
    """Every stage's result, each made from the one before."""
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(staged(stage(spark, docs[-1], SF), "test"))
    return docs


def test_order_and_columns(steps):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "exact dedup", "minhash near-dedup", "personal data", "packing"]
    assert all(df.columns == steps[0].columns for df in steps[1:-1])


def test_quality_stage_keeps_what_the_classifier_accepts(spark, steps):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    want = {r.doc_id for r in quality.classify(steps[0], labels).collect() if r.accepted}
    assert set(texts_of(steps[1])) == want
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert good <= want and len(bad & want) <= 0.1 * len(bad)


def test_exact_stage_keeps_the_largest_id_of_each_text(steps):
    best = {}
    for doc, text in texts_of(steps[1]).items():
        key = text.translate(str.maketrans(UPPER, LOWER))
        best[key] = max(best.get(key, doc), doc)
    assert sorted(texts_of(steps[2])) == sorted(best.values())


def test_near_stage_keeps_the_smallest_id_of_each_class(steps):
    docs = texts_of(steps[2])
    sets, root = {d: minhash.shingles(t) for d, t in docs.items()}, {d: d for d in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in docs:
        for b in docs:
            if a < b and minhash.similarity(sets[a], sets[b]) >= minhash.THRESHOLD:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    assert set(texts_of(steps[3])) == {find(d) for d in docs}


def test_private_stage_masks_and_keeps_all(steps):
    before, after = texts_of(steps[3]), texts_of(steps[4])
    assert after == {d: pii.masked(t) for d, t in before.items()} and after != before
    assert not any(pii.find(t) for t in after.values())


def test_packing_stage_and_run(spark, steps):
    whole = corpus_pipeline.run(spark, SF)
    assert whole.columns == steps[5].columns
    pieces = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, whole.select(pieces).collect())) == sorted(
        map(tuple, steps[5].select(pieces).collect())
    )
    assert {r.doc_id for r in whole.collect()} == set(texts_of(steps[4]))
    known = packing.word_ids(corpus_pipeline.WORD_BPE)
    tokens = sum(len(known.document(t)) // 4 for t in texts_of(steps[4]).values())
    assert sum(r.length for r in whole.collect()) == tokens


def test_nothing_staged_outlives_its_run(spark):
    """After a run's folder is left, neither files nor tables of it remain."""
    from adlake.llm.queries import QUERIES

    before = {t.name for t in spark.catalog.listTables()}
    with run_folder(spark) as folder:
        packed = corpus_pipeline.run(spark, SF)
        assert packed.count() > 0
        # The stages' own files are gone, and so is every stage's result but the last one's.
        kinds = {name.split("-")[0] for name, _, _ in files.children(spark, folder)}
        assert kinds <= {"personal", "pieces"}
        for name in ("op1_multi_index", "op6_exact_dedup", "op11_member_lloyd", "op12_pair_maxscore", "op13_direct_codes"):
            assert QUERIES[name](spark, SF).count() > 0
    assert not files.exists(spark, folder)
    assert {t.name for t in spark.catalog.listTables()} == before


def test_stages_take_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    for given, least in ((odd_docs, 1), (no_docs, 0)):
        docs = given
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = staged(stage(spark, docs, SF), "odd")
            assert docs.columns == given.columns, name
        assert docs.count() >= least
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert packed.count() >= docs.count()


def test_digest_index_is_the_one_of_the_operator(spark, documents):
    index = exact_dedup.DigestIndex(spark)
    kept = exact_dedup.first_rows(documents, index)
    assert kept.count() == index.read().count()
    index.close()
