import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from adlake.llm import packing
from adlake.llm.queries import WORD_BPE

PATH = WORD_BPE


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


def expect(tokenizer, texts, capacity):
    pieces = Counter()
    for doc, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            raw = np.array(part, dtype="<u4").tobytes()
            pieces[(doc, n, at, len(part), zlib.crc32(raw))] += 1
    return pieces


def check(rows, tokenizer, texts, capacity):
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert got == expect(tokenizer, texts, capacity)
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(held)


def test_whole_table(documents, tokenizer):
    texts = [(r.doc_id, r.text) for r in documents.collect()]
    rows = packing.pack(documents, PATH).collect()
    used = check(rows, tokenizer, texts, 2048)
    assert used <= -(-sum(r.length for r in rows) // 2048) + 1


def test_odd_rows_and_empty(odd_docs, no_docs, tokenizer):
    texts = [(r.doc_id, r.text) for r in odd_docs.collect()]
    check(packing.pack(odd_docs, PATH, 64).collect(), tokenizer, texts, 64)
    assert packing.pack(no_docs, PATH).count() == 0


def test_words_are_tokenized_as_the_library_does(tokenizer):
    known = packing.WordIds(PATH)
    parts = ["a", "É", "ß.", "İ.", "ΑΣ", "é", "́", "中", "\U0001f600", "'s", "don't,", "1", "22", "\x1c",
             "\xa0", " ", "\t", "\n", " ", "...", "<|endoftext|>", "x" * 60, "ª", "µ.", "'S", "क़."]
    rng = np.random.default_rng(3)
    for _ in range(4000):
        text = "".join(rng.choice(parts, rng.integers(0, 20)))
        want = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        assert np.frombuffer(known.document(text), "<u4").tolist() == want, repr(text)


def test_special_tokens_are_those_of_an_unmodified_tokenizer(spark):
    from tokenizers import Tokenizer

    unmodified = Tokenizer.from_file(PATH)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext|", "a", "B.", "É,", "ß", "1", "中",
             " ", "\n", "\t", "...", "'s", "x" * 60]
    rng = np.random.default_rng(4)
    texts = ["<|endoftext|>", "end<|endoftext|>.", "<|startoftext|>A b.<|endoftext|>, c"]
    texts += ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(2000)]
    texts = list(enumerate(texts))
    assert unmodified.encode(texts[0][1], add_special_tokens=False).ids == [49407]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    check(packing.pack(docs, PATH, 16).collect(), unmodified, texts, 16)


@pytest.mark.parametrize("lengths", ["uniform", "short", "half", "same"])
def test_plan_holds_everything_in_few_sequences(lengths):
    rng = np.random.default_rng(1)
    drawn = {
        "uniform": rng.integers(1, 2048, 50_000),
        "short": np.minimum(2048, rng.lognormal(6, 1, 200_000).astype(int) + 1),
        "half": rng.integers(900, 1300, 3000),
        "same": np.full(30_000, 700),
    }[lengths]
    histogram = Counter(int(x) for x in drawn)
    plan, held = packing.plan(histogram), Counter()
    for pattern, repeats in plan:
        assert sum(pattern) <= 2048 and repeats > 0
        for length in pattern:
            held[length] += repeats
    assert held == histogram
    counts = np.zeros(2049, dtype=np.int64)
    for length, n in histogram.items():
        counts[length] = n
    assert sum(r for _, r in plan) <= 1.001 * sum(r for _, r in packing.best_fit(counts)) + 1


def test_plan_size_does_not_follow_the_number_of_documents():
    sizes = []
    for times in (1, 1000):
        histogram = {n: (n % 7 + 1) * times for n in range(1, 2049)}
        sizes.append(len(packing.plan(histogram)))
    assert sizes[1] < 4 * sizes[0] + 4096
