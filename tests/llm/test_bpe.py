import hashlib
import random

import numpy as np
import pytest
import tiktoken
from public_tokenizers import PATTERN

from adlake.llm import bpe
from adlake.llm.queries import BYTE_BPE

PATH = BYTE_BPE


@pytest.fixture(scope="module")
def known():
    return bpe.vocabulary(PATH, PATTERN)


@pytest.fixture(scope="module")
def library(known):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=known.ranks, special_tokens={})


def ids(known, text):
    return np.frombuffer(known.encode(text), "<u4").tolist()


def test_equals_the_library(known, library):
    rng = random.Random(1)
    parts = ["a", "b", " ", "the", "ing", " \n", "\t", "é", "ß", "中", "\U0001f600", "'s", "'", "1", "22", "...", "\x1c",
             "\x85", "\xa0", " ", "　", "᠎", "aaaa", "====", "x" * 50, "‍", "İ", "<|endoftext|>"]
    for _ in range(8000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        assert ids(known, text) == library.encode_ordinary(text), repr(text)
    for _ in range(200):
        text = "".join(rng.choice("abcdefgthe") for _ in range(2000))
        assert ids(known, text) == library.encode_ordinary(text)


def test_long_cuts_take_linear_time(known):
    assert known.decode(known.encode("a" * 1_000_000)) == b"a" * 1_000_000


def test_whole_table_and_odd_rows(documents, odd_docs, no_docs, library):
    for docs in (documents, odd_docs):
        want = sorted(
            (str(r.doc_id), hashlib.sha256(np.array(library.encode_ordinary(r.text or ""), "<u4").tobytes()).hexdigest(),
             hashlib.sha256((r.text or "").encode()).hexdigest())
            for r in docs.collect()
        )
        rows = bpe.round_trip(docs, PATH, PATTERN).collect()
        assert sorted((str(r.doc_id), r.ids_sha256, r.decoded_sha256) for r in rows) == want
    encoded = {r.doc_id: r.ids for r in bpe.encode(odd_docs, PATH, PATTERN).collect()}
    assert encoded[3] == [] and encoded[8] == library.encode_ordinary("x")
    assert bpe.encode(no_docs, PATH, PATTERN).count() == bpe.round_trip(no_docs, PATH, PATTERN).count() == 0
