import hashlib

from adlake.llm import exact_dedup
from adlake.llm.common import LOWER, UPPER


def plain(text):
    return (text or "").translate(str.maketrans(UPPER, LOWER))


def test_groups_of_odd_rows(spark, odd_docs):
    rows = exact_dedup.classify(odd_docs, exact_dedup.DigestIndex(spark)).collect()
    texts = [(r.doc_id, plain(r.text)) for r in odd_docs.collect()]
    want = {}
    for doc, text in texts:
        want.setdefault(hashlib.sha256(text.encode()).hexdigest(), []).append(doc)
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(d) for d, _ in texts)
    for r in rows:
        ids = want[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
    assert sum(r.kept for r in rows) == len(want)
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_only_ascii_letters_are_folded(spark):
    docs = spark.createDataFrame([(1, "Éa"), (2, "éA"), (3, "éa"), (4, "K"), (5, "K")], "doc_id bigint, text string")
    kept = {r.doc_id for r in exact_dedup.classify(docs, exact_dedup.DigestIndex(spark)).collect() if r.kept}
    assert kept == {1, 3, 4, 5}


def test_index_lasts_and_a_repeated_batch_changes_nothing(spark, tmp_path):
    path, schema = str(tmp_path / "index"), "doc_id bigint, text string"
    first = spark.createDataFrame([(1, "a"), (2, "A"), (3, "b")], schema)
    index = exact_dedup.DigestIndex(spark, path, buckets=4)
    for _ in range(2):
        assert {r.doc_id for r in exact_dedup.first_rows(first, index).collect()} == {2, 3}
    index.close()
    again = exact_dedup.DigestIndex(spark, path, buckets=4)
    assert again.read().count() == 2
    second = spark.createDataFrame([(9, "a"), (8, "c"), (7, "C")], schema)
    rows = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.classify(second, again).collect()}
    assert rows == {9: (2, False), 8: (8, True), 7: (8, False)}
    assert again.read().count() == 3
    again.close()


def test_rewriting_merges_files_and_changes_buckets(spark, tmp_path):
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "many"), buckets=4)
    for n in range(3):
        batch = spark.range(40).selectExpr(f"sha2(cast(id + {40 * n} AS string), 256) AS digest", "id AS keep_id")
        index.append(batch)
    whole = index.rewritten(str(tmp_path / "whole"))
    more = index.rewritten(str(tmp_path / "more"), buckets=8)
    assert len(index.read().inputFiles()) == 12
    assert (len(whole.read().inputFiles()), len(more.read().inputFiles())) == (4, 8)
    rows = sorted(map(tuple, index.read().collect()))
    assert sorted(map(tuple, whole.read().collect())) == rows == sorted(map(tuple, more.read().collect()))
    for each in (index, whole, more):
        each.close()


def test_index_side_of_the_join_is_not_shuffled(spark):
    index = exact_dedup.DigestIndex(spark, buckets=4)
    batch = spark.createDataFrame([("d",)], "digest string")
    plan = batch.join(index.read().hint("merge"), "digest", "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and text.count("Exchange") == 1


def test_first_rows_keeps_columns_and_one_of_repeated_rows(spark, odd_docs, no_docs):
    out = exact_dedup.first_rows(odd_docs, exact_dedup.DigestIndex(spark))
    assert out.columns == odd_docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert sorted(i for i in ids if i is not None) == [2, 4, 5, 6, 7, 9] and ids.count(None) == 1
    index = exact_dedup.DigestIndex(spark)
    assert exact_dedup.first_rows(no_docs, index).count() == 0
    assert exact_dedup.classify(no_docs, index).count() == 0
