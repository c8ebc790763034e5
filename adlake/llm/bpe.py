"""Byte-level BPE encoding in linear time, and decoding.

A text is cut by the tokenizer's pattern; each cut is encoded on its own. Merging pair by pair
is not simulated: a cut's encoding is the only sequence of tokens covering it in which every two
neighbours are *compatible*, that is, encoding just these two tokens' bytes gives them back. An
automaton over the bytes, written as Latin-1 letters, finds the longest token at every position;
the search takes the longest token that fits its left neighbour, falls back to the token's
prefixes, and steps back where none fits. A position given up once is never tried again, so the
work is linear in the cut. Compatibility of two tokens is remembered, and so are short cuts.

Nulls: a null text is empty and has no ids. Repeated rows give repeated rows. Texts are encoded
whole, however long. An empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from adlake.llm.common import slices

#: Remembered cuts and pairs per worker process; a full memory is emptied.
MEMORY = 600_000
#: Longer cuts are encoded each time they occur.
REMEMBERED_CHARS = 48

#: Fixed by Unicode: the property White_Space, as the tokenizer's own regex engine reads ``\s``.
SPACE = r"\t-\r \x85\xa0  -     　"


def pattern(source: str) -> regex.Pattern:
    """The pattern with ``\\s`` and ``\\S`` spelled out as Unicode white space."""
    inside = source.replace(r"[^\s", f"[^{SPACE}")
    return regex.compile(inside.replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]"))


class Vocabulary(dict):
    """Encodes cuts; as a dict it maps remembered cuts to their ids as little-endian bytes."""

    def __init__(self, path: str, source: str):
        super().__init__()
        with open(path, "rb") as lines:
            entries = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in entries}
        self.cuts = pattern(source)
        self.tokens = dict(sorted((rank, token) for token, rank in self.ranks.items()))
        self.lengths = {rank: len(token) for rank, token in self.tokens.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token) - 1))
        self.automaton.make_automaton()
        self.halves = {r: self.last_merge(t) for r, t in self.tokens.items() if len(t) > 1}
        self.shorter = {r: self.prefix(t) for r, t in self.tokens.items()}.__getitem__
        self.pairs: dict[tuple[int, int], bool] = {}

    def last_merge(self, token: bytes) -> tuple[int, int] | None:
        """The two tokens whose merge made this one, by merging its bytes up to two parts."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = min(
                (self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1)
            )
            if best == 1 << 60:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def prefix(self, token: bytes) -> int | None:
        """The longest token that is a proper prefix of this one."""
        cuts = (token[:n] for n in range(len(token) - 1, 0, -1))
        return next((self.ranks[c] for c in cuts if c in self.ranks), None)

    def compatible(self, left: int, right: int) -> bool:
        """Whether encoding the two tokens' bytes together gives these two tokens.

        Merges happen by rank, the left one first among equals. Undoing them from the last,
        two parts touch across the border for a while; had they a merge of their own before
        either was merged further, it would have crossed the border.
        """
        if len(self.pairs) >= MEMORY:
            self.pairs.clear()
        fits = self.pairs[left, right] = self.touches(left, right)
        return fits

    def touches(self, left: int, right: int) -> bool:
        before = 1 << 60
        while True:
            crossing = self.ranks.get(self.tokens[left] + self.tokens[right])
            if crossing is not None and crossing < before:
                return False
            undo_left, undo_right = self.halves.get(left), self.halves.get(right)
            if undo_left and (not undo_right or left > right):
                before, left = left, undo_left[1]
            elif undo_right:
                before, right = right + 1, undo_right[0]
            else:
                return True

    def encode_cut(self, cut: str) -> list[int]:
        raw = cut.encode("utf-8")
        whole = self.ranks.get(raw)
        if whole is not None:
            return [whole]
        longest, lengths, pairs = [0] * len(raw), self.lengths, self.pairs
        for end, (rank, back) in self.automaton.iter(raw.decode("latin-1")):
            longest[end - back] = rank  # later ends are longer
        open_at = bytearray(b"\x01") * (len(raw) + 1)
        ids: list[int] = []
        at, token, last = 0, longest[0], None
        while True:
            end = at + lengths[token]
            if open_at[end]:
                fits = True if last is None else pairs.get((last, token))
                if fits is None:
                    fits = self.compatible(last, token)
                if fits:
                    ids.append(token)
                    if end == len(raw):
                        return ids
                    at, last, token = end, token, longest[end]
                    continue
            token = self.shorter(token)
            if token is None:
                open_at[at] = 0
                token = ids.pop()
                at -= lengths[token]
                last = ids[-1] if ids else None

    def __missing__(self, cut: str) -> bytes:
        ids = np.array(self.encode_cut(cut), dtype="<u4").tobytes()
        if len(cut) <= REMEMBERED_CHARS:
            if len(self) >= MEMORY:
                self.clear()
            self[cut] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.__getitem__, self.cuts.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=2)
def vocabulary(path: str, source: str) -> Vocabulary:
    """One per worker process and file, kept between tasks."""
    return Vocabulary(path, source)


def encode(docs: DataFrame, path: str, source: str) -> DataFrame:
    """(doc_id, ids): ``ids`` are the text's token ids, an array of int."""

    def run(batches):
        known = vocabulary(path, source)
        for batch in batches:
            for rows in slices(batch):
                ids = [
                    np.frombuffer(known.encode(text or ""), dtype="<u4").astype(np.int32)
                    for text in rows.column(1).to_pylist()
                ]
                values = pa.array(np.concatenate([np.empty(0, np.int32), *ids]))
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([rows.column(0), lists], ["doc_id", "ids"])

    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(
        run, "doc_id bigint, ids array<int>"
    )


def round_trip(docs: DataFrame, path: str, source: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256); ids and bytes stay inside the task."""

    def run(batches):
        known = vocabulary(path, source)
        for batch in batches:
            for rows in slices(batch):
                counts, ids_sha, bytes_sha = [], [], []
                for text in rows.column(1).to_pylist():
                    ids = known.encode(text or "")
                    counts.append(len(ids) // 4)
                    ids_sha.append(hashlib.sha256(ids).hexdigest())
                    bytes_sha.append(hashlib.sha256(known.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array(counts, pa.int64()),
                        pa.array(ids_sha, pa.string()),
                        pa.array(bytes_sha, pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


