"""Files of directly addressable codes: round trips, random access, order and odd rows."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from adlake.llm import direct_codes
from adlake.llm.direct_codes import Codes, Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
ids = st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=200)


def opened(data):
    return Codes(lambda at, size: data[at : at + size])


def encoded(docs):
    made = Encoder()
    for n, values in enumerate(docs):
        made.add([n], [len(values)], np.array(values, dtype="<u4"))
    return opened(made.data())


@settings(deadline=None, max_examples=60)
@given(st.lists(ids, max_size=6), st.randoms())
def test_any_range_is_read_directly(docs, rng):
    codes, flat = encoded(docs), [v for d in docs for v in d]
    names, starts = codes.index()
    assert names == list(range(len(docs))) and starts.tolist() == np.cumsum([0, *map(len, docs)]).tolist()
    assert codes.ids(0, len(flat)).tolist() == flat
    for _ in range(5):
        at = rng.randint(0, len(flat))
        count = rng.randint(0, len(flat) - at)
        assert codes.ids(at, count).tolist() == flat[at : at + count]


def test_a_token_costs_a_few_short_reads():
    values = (np.arange(200_000, dtype=np.uint32) * 7919) % 49_408
    made = Encoder()
    made.add([1], [len(values)], values)
    data, sizes = made.data(), []
    codes = Codes(lambda at, size: sizes.append(size) or data[at : at + size])
    for place in (0, 511, 512, 513, 99_999, 199_999):
        sizes.clear()
        assert codes.token(place) == values[place]
        assert sum(sizes) < 200
    assert len(data) < 2.5 * len(values)


def expected(docs):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    for doc, text in docs:
        found = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        data = np.array(found, dtype="<u4").tobytes()
        out.append((doc, start, len(found), zlib.crc32(data)))
        start += len(found)
    return out


def rows_of(df):
    return [tuple(r) for r in df.orderBy("start").select("doc_id", "start", "n_tokens", "ids_crc32").collect()]


@pytest.mark.parametrize("file_tokens", [64, direct_codes.FILE_TOKENS])
def test_equals_the_tokenizer(spark, documents, monkeypatch, file_tokens):
    monkeypatch.setattr(direct_codes, "FILE_TOKENS", file_tokens)
    docs = documents.repartition(4)
    texts = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    assert rows_of(direct_codes.write_and_read(docs, PATH)) == expected(texts)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = rows_of(direct_codes.write_and_read(odd_docs, PATH))
    plain = {(d, n, c) for d, _, n, c in expected([tuple(r) for r in odd_docs.select("doc_id", "text").collect()])}
    assert {(d, n, c) for d, _, n, c in rows} == plain and len(rows) == odd_docs.count()
    assert [s for _, s, _, _ in rows] == [sum(n for _, _, n, _ in rows[:i]) for i in range(len(rows))]
    order = [d for d, _, _, _ in rows]
    assert order == sorted(order, key=lambda d: (d is not None, d))
    assert direct_codes.write_and_read(no_docs, PATH).count() == 0


def test_special_tokens_keep_their_ids(spark):
    docs = spark.createDataFrame([(1, "a <|endoftext|> b"), (2, "<|startoftext|>")], "doc_id bigint, text string")
    assert rows_of(direct_codes.write_and_read(docs, PATH)) == expected([(1, "a <|endoftext|> b"), (2, "<|startoftext|>")])


def test_starts_over_many_files(spark, monkeypatch):
    monkeypatch.setattr(direct_codes, "FILE_GROUP", 3)
    rows = [(task, n, f"f{task}-{n}", 1, task + n + 1) for task in range(10) for n in range(2)]
    manifest = spark.createDataFrame(rows, "task int, number int, file string, documents bigint, tokens bigint")
    got = [r["first"] for r in direct_codes.with_starts(manifest).orderBy("task", "number").collect()]
    sizes = [r[4] for r in rows]
    assert got == [sum(sizes[:n]) for n in range(len(sizes))]
