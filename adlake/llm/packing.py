"""Packing documents into fixed-length sequences by patterns and least squares.

Documents become token pieces of at most ``capacity``; only their lengths matter for packing,
and there are at most ``capacity`` different ones. The histogram of lengths is all that reaches
the driver. There:

1. *patterns* of few lengths that fill a sequence exactly are enumerated,
2. non-negative least squares fits how often each is repeated so that together they use the
   histogram, longer lengths weighing more, since they are harder to place later,
3. repeats are rounded within what the histogram holds,
4. what remains is packed best-fit, longest first, by counts of equal lengths and equal bins.

The plan is a list of (pattern, repeats): its size depends on the lengths, not on the number of
documents. Pieces are numbered within each length and look their place up by (length, number).

Nulls: a null text is empty and has the closing id alone. Repeated rows are packed once each.
Ties between pieces of one length are broken by id, piece and content; it does not matter which
equal-length piece goes where. An empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import bisect
import struct
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import numbered, slices, staged

CAPACITY = 2048
CLOSING_ID = 0
#: Lengths that serve as the inner members of patterns, taken at equal shares of all tokens.
INNER = {3: 24, 4: 8, 5: 4}
STEPS = 300

#: Words remembered per worker process in each of two generations: when the young one is full it
#: becomes the old one, from which words still in use come back.
MEMORY = 400_000
REMEMBERED_CHARS = 48


class WordIds(dict):
    """Token ids of blank-separated words, as little-endian bytes, remembered by word.

    The tokenizer drops white space and never merges across it, so a text's ids are its
    words' ids in order. A word of Latin-1 letters goes to the merge model directly, in lower
    case and as the byte alphabet's letters, with full stops and commas after it cut off;
    any other word through the whole tokenizer, which gives its special tokens' ids to words that
    spell them, unless ``spelled_out``.
    """

    def __init__(self, path: str, spelled_out: bool = True):
        super().__init__()
        from tokenizers import Tokenizer

        self.old: dict[str, bytes] = {}

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = spelled_out
        self.merge = self.tokenizer.model.tokenize
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.letters = {b: 256 + n for n, b in enumerate(hidden)}

    def ids(self, word: str) -> bytes:
        body = word.rstrip(".,")
        if body and body != word and body[-1].isalpha() and body[-1] < "Ā":
            return self[body] + self[word[len(body) :]]
        plain = word.isascii()
        if word.isalpha() and (plain or max(word) < "Ā"):
            low = word.lower()
            if low != word:
                return self[low]
            # ASCII letters stand for themselves in the byte alphabet.
            spelled = word if plain else word.encode().decode("latin-1").translate(self.letters)
            return packed([token.id for token in self.merge(spelled)])
        return packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.ids(word)
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= MEMORY:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def document(self, text: str) -> bytes:
        words = text.replace("\n", " ").split(" ")
        return b"".join(map(self.__getitem__, words)) + packed([CLOSING_ID])


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One per worker process and file, kept between tasks."""
    return WordIds(path, spelled_out=False)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): one row per piece of at most ``capacity``."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches):
        known = word_ids(path)
        for batch in batches:
            for rows in slices(batch):
                out: list[list] = [[] for _ in columns]
                for doc, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                    ids = known.document(text or "")
                    for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        row = (doc, n, at // 4, len(part) // 4, zlib.crc32(part))
                        for column, value in zip(out, row):
                            column.append(value)
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, out, types)), columns)

    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(
        run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


def patterns(counts: np.ndarray) -> np.ndarray:
    """Length patterns that fill a sequence exactly, one per row, padded with 0.

    All pairs, and for 3 to 5 members every choice of inner members from INNER lengths with
    any present length before and whatever closes the sequence after them. ``counts[n]`` is the
    number of pieces of length n; the capacity is its last index.
    """
    capacity = len(counts) - 1
    present = np.flatnonzero(counts[:capacity])
    present = present[present > 0]
    rows = []

    def close(inner: tuple[int, ...]) -> None:
        first = present
        last = capacity - sum(inner) - first
        ok = (last > 0) & (last <= first)
        first, last = first[ok], last[ok]
        ok = counts[last] > 0
        block = np.zeros((int(ok.sum()), max(INNER)), dtype=np.int64)
        block[:, 0], block[:, 1] = first[ok], last[ok]
        block[:, 2 : 2 + len(inner)] = inner
        rows.append(block)

    close(())
    tokens = np.cumsum(present * counts[present])
    for members, wanted in INNER.items():
        if not len(present):
            break
        shares = (np.arange(wanted) + 0.5) / wanted * tokens[-1]
        picks = sorted({int(x) for x in present[np.searchsorted(tokens, shares)]})

        def choose(chosen: tuple[int, ...], left: int) -> None:
            if sum(chosen) >= capacity:
                return
            if not left:
                close(chosen)
                return
            for pick in picks:
                if not chosen or pick >= chosen[-1]:
                    choose((*chosen, pick), left - 1)

        choose((), members - 2)
    found = np.concatenate(rows) if rows else np.zeros((0, max(INNER)), dtype=np.int64)
    return np.unique(-np.sort(-found, axis=1), axis=0)


def fit(shapes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Non-negative repeats whose use of lengths is closest to ``counts``, by accelerated
    projected gradient steps on the weighted squares."""
    size = len(counts)
    weight = np.arange(size) / (size - 1)
    weight[0] = 0.0
    goal = weight * counts
    flat = shapes.ravel()

    def use(x: np.ndarray) -> np.ndarray:
        return np.bincount(flat, np.repeat(x, shapes.shape[1]), size) * weight

    def back(r: np.ndarray) -> np.ndarray:
        return (r * weight)[shapes].sum(axis=1)

    bound = np.ones(len(shapes))
    for _ in range(20):  # power iteration: the largest curvature fixes the step
        bound = back(use(bound))
        bound /= np.linalg.norm(bound)
    step = 0.95 / np.linalg.norm(back(use(bound)))
    x = ahead = np.zeros(len(shapes))
    speed = 1.0
    for _ in range(STEPS):
        new = np.maximum(0.0, ahead - step * back(use(ahead) - goal))
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        ahead = new + (speed - 1) / faster * (new - x)
        x, speed = new, faster
    return x


def rounded(shapes: np.ndarray, x: np.ndarray, counts: np.ndarray) -> list[tuple[tuple, int]]:
    """Whole repeats, the most repeated first, within what is left; lowers ``counts``."""
    plan = []
    for n in np.lexsort((np.arange(len(x)), -x)):
        repeats = int(x[n] + 0.5)
        if repeats == 0:
            break
        lengths, times = np.unique(shapes[n][shapes[n] > 0], return_counts=True)
        repeats = min(repeats, int((counts[lengths] // times).min()))
        if repeats:
            counts[lengths] -= repeats * times
            plan.append((tuple(int(v) for v in shapes[n] if v), repeats))
    return plan


def best_fit(counts: np.ndarray) -> list[tuple[tuple, int]]:
    """Best-fit decreasing over counts: bins of equal content are one entry with a count."""
    capacity = len(counts) - 1
    rooms: list[int] = []  # free space of open bins, ascending
    bins: dict[int, list[tuple[tuple, int]]] = defaultdict(list)
    done = []

    def put(content: tuple, count: int, room: int) -> None:
        if room == 0:
            done.append((content, count))
            return
        if not bins[room]:
            bisect.insort(rooms, room)
        bins[room].append((content, count))

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):  # none has room: open full new bins, then one for the rest
                each = capacity // length
                if left >= each:
                    put((length,) * each, left // each, capacity - each * length)
                    left %= each
                if left:
                    put((length,) * left, 1, capacity - left * length)
                    left = 0
                continue
            room = rooms[at]
            content, count = bins[room].pop()
            if not bins[room]:
                rooms.pop(at)
            each = min(room // length, left)
            filled = min(count, left // each)
            put(content + (length,) * each, filled, room - each * length)
            if count > filled:
                put(content, count - filled, room)
            left -= filled * each
    return done + [entry for room in rooms for entry in bins[room]]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple, int]]:
    """(pattern, repeats) entries that together hold every piece once."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in histogram.items():
        counts[length] = count
    out = [((capacity,), int(counts[capacity]))] if counts[capacity] else []
    counts[capacity] = 0
    shapes = patterns(counts)
    if len(shapes):
        out += rounded(shapes, fit(shapes, counts), counts)
    return out + best_fit(counts)


def places(entries: list[tuple[tuple, int]]) -> tuple[np.ndarray, ...]:
    """The plan as sorted slots: key of (length, first number), first sequence, offset."""
    used: dict[int, int] = defaultdict(int)
    keys, sequences, offsets, sequence = [], [], [], 0
    for pattern, repeats in entries:
        offset = 0
        for length in pattern:
            keys.append((length << 44) + used[length])
            sequences.append(sequence)
            offsets.append(offset)
            used[length] += repeats
            offset += length
        sequence += repeats
    order = np.argsort(np.array(keys, dtype=np.int64), kind="stable")
    return tuple(np.array(v, dtype=np.int64)[order] for v in (keys, sequences, offsets))


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = staged(pieces(docs, path, capacity), "pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    keys, sequences, offsets = places(plan(histogram, capacity))
    order = ["doc_id", "piece", "ids_crc32"]
    ranked = numbered(cut, ["length"], order, "rank", max(histogram.values(), default=0))

    def run(batches):
        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in (3, 5))
            key = (length << 44) + rank
            at = np.searchsorted(keys, key, side="right") - 1
            found = [sequences[at] + key - keys[at], offsets[at]] if len(key) else [[], []]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], *(pa.array(v, pa.int64()) for v in found)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("rank")).mapInArrow(
        run,
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
        "sequence_id bigint, offset bigint",
    )
