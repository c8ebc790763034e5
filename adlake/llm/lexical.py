"""Ranked lexical search with MaxScore whose bounds know about pairs of terms.

The score of a document is a sum of impacts, one per term of the item. Three jobs answer a set of
items; each reads what the one before wrote to the shared folder:

1. *Forward rows*: one pass over all texts counts their terms, and how often each holds a term of
   the items. The counts of documents and terms are totals over all documents.
2. *Segments*: runs of documents with, for every term, the list of its documents and impacts, and
   with the intersection of every pair of terms that are neighbours in an item, heaviest terms
   first. A list keeps its highest impact, an intersection its highest joint impact, and each the
   impact that ``k`` of its documents reach.
3. *Search*: a task goes through its segments with the best ``k`` documents of each item so far.
   What the remaining terms of an item can add is bounded by the best combination of single lists
   and neighbouring pairs: with b(i) the bound of terms i onwards, b(i) is the lesser of
   top(i) + b(i+1) and pair(i, i+1) + b(i+2), where pair is the largest of both lists' and the
   intersection's highest impacts. A segment whose bound is below the threshold is skipped; terms
   whose bound is below it are only looked up for documents already found. Thresholds start from
   the impact that ``k`` documents of one list or intersection of one segment are known to reach.

Nothing is estimated: a document is passed over only when its bound is below the threshold. A
task returns at most ``k`` rows per item, which are merged in two steps. Items are taken in
blocks of at most about ``BLOCK_BYTES`` of text, so what every task is given is bounded.

Every row of the table is a document. A null text has no terms. Equal scores are ranked by id,
null ids last, and rows equal in both get neighbouring ranks. Every different (item_id, text) is
an item of its own, also with a null id; an item without terms finds nothing. Very long texts are
read in slices. Empty tables give an empty result; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.common import slices, staged

TOP = 50
#: Text of the items that one pass over the documents answers.
BLOCK_BYTES = 8 << 20
#: A segment ends with as many documents or list entries.
SEGMENT_DOCS, SEGMENT_POSTINGS = 8_192, 2_000_000
#: Bytes of a text that are words at a time.
SLICE_BYTES = 4 << 20
#: First step of the final merge.
MERGE_PARTS = 256

#: In UTF-8 the separators are single bytes, and no other character contains such a byte.
LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)

SEPARATOR = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def terms_of(text: bytes):
    """The terms of a text in order, a slice at a time."""
    start = 0
    while start < len(text):
        gap = SEPARATOR.search(text, start + SLICE_BYTES)
        end = gap.start() if gap else len(text)
        yield text[start:end].translate(LETTERS).split()
        start = end


@dataclass(frozen=True)
class Items:
    """A block of items: their ids, their terms by number, the numbers of all terms, and the
    pairs of neighbouring terms. Filled in order of weight once weights are known."""

    ids: list
    terms: list[list[int]]
    numbers: dict[bytes, int]

    def ordered(self, weights: np.ndarray) -> Items:
        heaviest = [sorted(t, key=lambda n: (-weights[n], n)) for t in self.terms]
        return Items(self.ids, heaviest, self.numbers)

    def pairs(self) -> list[tuple[int, int]]:
        return sorted({pair for terms in self.terms for pair in zip(terms, terms[1:])})


def read_items(rows: list) -> Items:
    ids, terms, numbers = [], [], {}
    for item, text in rows:
        ids.append(item)
        words = {w for part in terms_of((text or "").encode()) for w in part}
        terms.append([numbers.setdefault(w, len(numbers)) for w in sorted(words)])
    return Items(ids, terms, numbers)


def forward_rows(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts) of every document that has a term; lists as 32-bit integers."""

    def run(batches):
        for batch in batches:
            for rows in slices(batch):
                ids, lengths, terms, counts = [], [], [], []
                for doc, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                    length, found = 0, Counter()
                    for words in terms_of(text or b""):
                        length += len(words)
                        found.update(map(numbers.get, words))
                    found.pop(None, None)
                    if length:
                        ids.append(doc)
                        lengths.append(length)
                        terms.append(np.array(list(found), dtype="<i4").tobytes())
                        counts.append(np.array(list(found.values()), dtype="<i4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(terms, pa.binary()),
                        pa.array(counts, pa.binary()),
                    ],
                    ["doc_id", "n", "terms", "counts"],
                )

    texts = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["text"].cast("string").cast("binary").alias("text"),
    )
    return texts.mapInArrow(run, "doc_id bigint, n bigint, terms binary, counts binary")


def document_counts(forward: DataFrame, terms: int) -> np.ndarray:
    """How many documents hold each term; a task returns at most one row per term."""

    def run(batches):
        held = np.zeros(terms, dtype=np.int64)
        for batch in batches:
            found = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype="<i4")
            held += np.bincount(found, minlength=terms)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], ["term", "df"])

    counted = forward.select("terms").mapInArrow(run, "term bigint, df bigint")
    totals = np.zeros(terms, dtype=np.int64)
    for row in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():
        totals[row["term"]] = row["df"]
    return totals


def weight(documents: int, held: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * held + 1)))


def segments(
    forward: DataFrame, weights: np.ndarray, pairs: list[tuple[int, int]], totals: tuple[int, int], k: int
) -> DataFrame:
    """The index, one row per segment: ids of its documents, its lists, and bounds of lists and
    intersections. List t belongs to term t, list len(weights) + p to pair p."""
    documents, length = totals
    seconds: dict[int, list[tuple[int, int]]] = {}
    for n, (a, b) in enumerate(pairs):
        seconds.setdefault(a, []).append((b, n))

    def reached(impacts: np.ndarray) -> int:
        return int(np.partition(impacts, len(impacts) - k)[-k]) if len(impacts) >= k else 0

    def close(rows: list[tuple]) -> pa.RecordBatch:
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0))
        m = np.array([100 - 50 + 50 * n * documents // length for _, n, _, _ in rows])
        sizes = [len(terms) // 4 for _, _, terms, _ in rows]
        doc = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
        term = np.frombuffer(b"".join(r[2] for r in rows), dtype="<i4")
        tf = np.frombuffer(b"".join(r[3] for r in rows), dtype="<i4").astype(np.int64)
        impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
        order = np.argsort(term, kind="stable")
        doc, term, impact = doc[order], term[order], impact[order]
        starts = np.searchsorted(term, np.arange(len(weights) + 1))
        lists, most, kth = [], [], []
        dense = np.zeros(len(rows), dtype=np.int64)
        for a in np.flatnonzero(np.diff(starts)).tolist():
            at = slice(starts[a], starts[a + 1])
            lists.append(a)
            most.append(int(impact[at].max()))
            kth.append(reached(impact[at]))
            if a not in seconds:
                continue
            dense[doc[at]] = impact[at]
            for b, pair in seconds[a]:
                other = slice(starts[b], starts[b + 1])
                mine = dense[doc[other]]
                joint = (mine + impact[other])[mine > 0]
                if len(joint):
                    lists.append(len(weights) + pair)
                    most.append(int(joint.max()))
                    kth.append(reached(joint))
            dense[doc[at]] = 0
        whole = [lists, most, kth, starts.tolist()]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([[r[0] for r in rows]], pa.list_(pa.int64())),
                *(pa.array([v], pa.list_(pa.int64())) for v in whole),
                pa.array([doc.astype("<i4").tobytes()], pa.binary()),
                pa.array([impact.astype("<i8").tobytes()], pa.binary()),
            ],
            ["doc_ids", "lists", "most", "kth", "starts", "docs", "impacts"],
        )

    def run(batches):
        rows: list[tuple] = []
        entries = 0
        for batch in batches:
            for part in slices(batch):
                columns = (part.column(n).to_pylist() for n in range(4))
                for row in zip(*columns):
                    if row[2]:
                        rows.append(row)
                        entries += len(row[2]) // 4
                    if len(rows) >= SEGMENT_DOCS or entries >= SEGMENT_POSTINGS:
                        yield close(rows)
                        rows, entries = [], 0
        if rows:
            yield close(rows)

    return forward.mapInArrow(
        run,
        "doc_ids array<bigint>, lists array<bigint>, most array<bigint>, kth array<bigint>, "
        "starts array<bigint>, docs binary, impacts binary",
    )


def first_thresholds(index: DataFrame, items: Items, pairs: dict[tuple[int, int], int]) -> list[int]:
    """For each item a score that its k-th best document reaches at least: k documents of one
    segment share one of its lists or intersections at that impact."""
    both = index.select(F.explode(F.arrays_zip("lists", "kth")).alias("l")).select("l.*")
    best = both.where("kth > 0").groupBy("lists").agg(F.max("kth").alias("kth"))
    # At most one row per term and pair of the block.
    known = {r["lists"]: r["kth"] for r in best.collect()}
    found = []
    for terms in items.terms:
        lists = [*terms, *(len(items.numbers) + pairs[p] for p in zip(terms, terms[1:]))]
        found.append(max((known.get(n, 0) for n in lists), default=0))
    return found


def bounds(tops: np.ndarray, joint: np.ndarray) -> np.ndarray:
    """b(i) of the module's description for terms in order; one more entry, 0, at the end."""
    b = np.zeros(len(tops) + 1, dtype=np.int64)
    for i in range(len(tops) - 1, -1, -1):
        b[i] = tops[i] + b[i + 1]
        if i + 1 < len(tops):
            b[i] = min(b[i], max(tops[i], tops[i + 1], joint[i]) + b[i + 2])
    return b


class Best:
    """The best k documents of one item so far."""

    def __init__(self, k: int, threshold: int):
        self.k, self.threshold = k, threshold
        self.found: list[tuple[int, bool, int]] = []

    def add(self, scores: list[int], ids: list) -> None:
        new = [(-s, i is None, i or 0) for s, i in zip(scores, ids)]
        self.found = sorted(self.found + new)[: self.k]
        if len(self.found) == self.k:
            self.threshold = max(self.threshold, -self.found[-1][0])


def top_scores(lists: list[tuple], bound: np.ndarray, size: int, k: int, threshold: int):
    """Documents of a segment whose score may be among the best k, and their scores."""
    total = np.zeros(size, dtype=np.int64)
    done = 0
    for docs, impacts in lists:
        if bound[done] < threshold:
            break
        total[docs] += impacts
        done += 1
        if bound[done] and np.count_nonzero(total) >= k:
            threshold = max(threshold, int(np.partition(total, size - k)[-k]))
    found = np.flatnonzero(total)
    scores = total[found]
    for n in range(done, len(lists)):  # looked up only for documents already found
        keep = scores + bound[n] >= threshold
        found, scores = found[keep], scores[keep]
        docs, impacts = lists[n]
        if not len(found) or not len(docs):
            continue
        at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
        hit = docs[at] == found
        scores[hit] += impacts[at[hit]]
        if len(scores) >= k:
            threshold = max(threshold, int(np.partition(scores, len(scores) - k)[-k]))
    keep = scores >= max(threshold, 1)
    found, scores = found[keep], scores[keep]
    order = np.lexsort((found, -scores))[:k]
    return found[order], scores[order]


def searched(
    index: DataFrame, items: Items, pairs: dict[tuple[int, int], int], thresholds: list[int], k: int
) -> DataFrame:
    """(item, doc_id, score): each task's best k documents of each item."""
    count = len(items.numbers)
    joined = [
        (np.array(terms, dtype=np.int64), np.array([count + pairs[p] for p in zip(terms, terms[1:])], dtype=np.int64))
        for terms in items.terms
    ]

    def run(batches):
        best = [Best(k, t) for t in thresholds]
        for batch in batches:
            for row in batch.to_pylist():
                top = np.zeros(count + len(pairs), dtype=np.int64)
                top[row["lists"]] = row["most"]
                starts, ids = row["starts"], row["doc_ids"]
                docs = np.frombuffer(row["docs"], dtype="<i4")
                impacts = np.frombuffer(row["impacts"], dtype="<i8")
                for (terms, joint), held in zip(joined, best):
                    bound = bounds(top[terms], top[joint])
                    if bound[0] < max(held.threshold, 1):
                        continue
                    lists = [
                        (docs[starts[t] : starts[t + 1]], impacts[starts[t] : starts[t + 1]])
                        for t in terms.tolist()
                    ]
                    found, scores = top_scores(lists, bound, len(ids), k, held.threshold)
                    held.add(scores.tolist(), [ids[n] for n in found.tolist()])
        rows = [(n, i, s) for n, held in enumerate(best) for s, _, i in _rows(held)]
        columns = list(zip(*rows)) or [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())],
            ["item", "doc_id", "score"],
        )

    return index.mapInArrow(run, "item int, doc_id bigint, score bigint")


def _rows(held: Best):
    for score, absent, doc in held.found:
        yield -score, absent, None if absent else doc


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each item from the tasks' bests."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(MERGE_PARTS))
    few = found.withColumn("part", part)
    few = few.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order)))
    few = few.where(F.col("rank") <= k).drop("rank", "part")
    last = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return few.withColumn("rank", last).where(F.col("rank") <= k)


def search_block(docs: DataFrame, items: Items, k: int) -> DataFrame:
    forward = staged(forward_rows(docs, items.numbers), "forward")
    count, length = forward.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = document_counts(forward, len(items.numbers))
    weights = np.array([weight(count, int(h)) for h in held], dtype=np.int64)
    items = items.ordered(weights)
    pairs = items.pairs()
    index = staged(segments(forward, weights, pairs, (count, length), k), "segments")
    numbers = {pair: n for n, pair in enumerate(pairs)}
    found = searched(index, items, numbers, first_thresholds(index, items, numbers), k)
    spark = docs.sparkSession
    named = spark.createDataFrame(list(enumerate(items.ids)), "item int, item_id bigint")
    # As many rows as the block has items.
    return ranked(found, k).join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """The ``k`` highest-scoring documents of every item: item_id, rank, doc_id, score."""
    texts = items.select(
        items["item_id"].cast("long").alias("item_id"), items["text"].cast("string").alias("text")
    ).where("text IS NOT NULL")
    texts = texts.distinct()
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    results = []
    for n in range(blocks):
        block = read_items([tuple(r) for r in texts.where(place == n).orderBy("item_id", "text").collect()])
        if block.numbers:
            results.append(search_block(docs, block, k))
    if not results:
        return texts.where("false").selectExpr("item_id", "0 AS rank", "0L AS doc_id", "0L AS score")
    found = results[0]
    for other in results[1:]:
        found = found.unionByName(other)
    return found
