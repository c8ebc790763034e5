"""Near-duplicate documents by ProbMinHash, banding and verification.

A document is the multiset of its shingles of ``SHINGLE`` words (lower-cased, separated by white
space; a shorter text is one shingle). Every shingle sends arrivals of a Poisson process whose
rate is its count; each arrival falls on a random register, which keeps the earliest and the
shingle it came from. A shingle stops once its next arrival cannot be the earliest anywhere.
Two documents agree in a register with the probability Jaccard similarity of their counts,
which is the plain Jaccard similarity where no shingle repeats. Registers are joined into
bands; documents that share a band are candidates and their similarity is computed exactly.

Texts that share a band are compared in parts of about ``BLOCK`` texts or ``BLOCK_SHINGLES``
shingles. Every part also holds the group's leader. Members that a part connects to the leader
are in one class and need no further comparison with each other; only the rest, usually nobody,
is compared with the members of all other parts. A group of copies is thus sent on once, however
large it is.

Different texts are told apart by their content and numbered, whatever their ids: one id may
stand on several texts, and ids may be null. A null text is empty; a text without words is like no
other. Equal texts are one. A class is named by the smallest id in it, null if it has none, and is
led by one row: of the rows with that id the one whose text was numbered first, once if it is
repeated. An empty table gives an empty result; very long texts are read whole; of extra columns
:func:`leaders` returns all and the rest none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.common import slices, staged, whole_text
from adlake.llm.graph import components, local_roots

SHINGLE = 5
BANDS, ROWS = 24, 6
THRESHOLD = 0.8
#: Texts, and shingles, of a part: about what a task compares at a time.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20
#: Shingles compared at a time within a task.
COLUMNS = 4096

#: Fixed by the public splitmix64 generator.
GOLDEN, MIX_1, MIX_2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64's finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_2)
    return x ^ (x >> np.uint64(31))


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes in order and how often each occurs."""
    import xxhash

    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = min(SHINGLE, len(words))
    total = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for n in range(size):
        total = mixed(total * np.uint64(GOLDEN) + hashes[n : n + len(total)])
    return np.unique(total, return_counts=True)


def registers(ids: np.ndarray, counts: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """The shingle kept by each register, shape (owners, BANDS * ROWS).

    ``owner`` is the ascending document number of each (shingle, count).
    """
    size = BANDS * ROWS
    earliest = np.full(owners * size, np.inf)
    kept = np.zeros(owners * size, dtype=np.uint64)
    time = np.zeros(len(ids))
    going, arrival = np.arange(len(ids)), 0
    while len(going):
        arrival += 1
        draw = mixed(ids[going] + np.uint64(arrival * GOLDEN & 0xFFFFFFFFFFFFFFFF))
        unit = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        time[going] -= np.log(unit) / counts[going]
        slot = owner[going] * size + (mixed(draw ^ np.uint64(MIX_2)) % np.uint64(size)).astype(np.int64)
        np.minimum.at(earliest, slot, time[going])
        won = earliest[slot] == time[going]
        kept[slot[won]] = ids[going[won]]
        docs = owner[going]
        first = np.concatenate([[True], docs[1:] != docs[:-1]])
        latest = earliest.reshape(owners, size)[docs[first]].max(axis=1)
        going = going[time[going] < latest[np.cumsum(first) - 1]]
    return kept.reshape(owners, size)


def bands(kept: np.ndarray) -> np.ndarray:
    """One hash per document and band."""
    parts = kept.reshape(len(kept), BANDS, ROWS)
    total = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
    for n in range(ROWS):
        total = mixed(total * np.uint64(GOLDEN) + parts[:, :, n])
    return total.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard similarity of two (sorted shingles, counts).

    For a shared shingle d with ratio r = b(d) / a(d) the term is
    1 / sum over all shingles of max(a / a(d), b / b(d)) = b(d) / sum of max(r a, b); shingles
    of one ratio share the sum.
    """
    shared, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    ca, cb = a[1][at_a].astype(float), b[1][at_b].astype(float)
    only_a, only_b = a[1].sum() - ca.sum(), b[1].sum() - cb.sum()
    total = 0.0
    for ratio in np.unique(cb / ca):
        here = cb / ca == ratio
        total += cb[here].sum() / (np.maximum(ratio * ca, cb).sum() + ratio * only_a + only_b)
    return float(total)


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, content, bands, shingles): ``content`` is a digest of the text, ``bands`` null if
    it has no word, ``shingles`` their number."""
    names = ["doc_id", "content", "bands", "shingles"]

    def run(batches):
        for batch in batches:
            for rows in slices(batch, 128):
                found = [shingles(text or "") for text in rows.column(2).to_pylist()]
                owner = np.repeat(np.arange(len(found)), [len(ids) for ids, _ in found])
                ids, counts = (np.concatenate(part) for part in zip(*found))
                hashes = bands(registers(ids, counts, owner, len(found)))
                ends = np.arange(0, hashes.size + 1, BANDS, dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.ravel()))
                # a text without words has no shingle and meets nobody
                size = pa.array([len(ids) for ids, _ in found], pa.int64())
                lists = pc.if_else(pc.greater(size, 0), lists, pa.scalar(None, lists.type))
                yield pa.RecordBatch.from_arrays([*rows.columns[:2], lists, size], names)

    narrow = docs.select(
        docs["doc_id"].cast("long"), content(docs), docs["text"].cast("string").alias("text")
    )
    return narrow.mapInArrow(
        run, "doc_id bigint, content string, bands array<bigint>, shingles bigint"
    )


def content(docs: DataFrame) -> Column:
    return F.sha2(F.encode(whole_text(docs["text"]), "UTF-8"), 256).alias("content")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(node, shingles, counts) from (node, text)."""

    def run(batches):
        for batch in batches:
            for rows in slices(batch, 128):
                found = [shingles(text or "") for text in rows.column(1).to_pylist()]
                ends = np.cumsum([0, *(len(ids) for ids, _ in found)], dtype=np.int32)
                ids, counts = (np.concatenate(part) for part in zip(*found))
                lists = [
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
                    for values in (ids.view(np.int64), counts.astype(np.int32))
                ]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), *lists], ["node", "shingles", "counts"]
                )

    return texts.mapInArrow(run, "node bigint, shingles array<bigint>, counts array<int>")


def groups_to_compare(texts: DataFrame) -> DataFrame:
    """(bucket, node, leader, parts), staged: the members of every band value that two texts share.

    Bands that hold the same texts are compared once: they agree in size, ends and the sum of
    their members' hashes. The leader is the first member; ``parts`` is how many parts the group
    is dealt into.
    """
    hits = texts.select("node", "shingles", F.explode("bands").alias("bucket"))
    same = ["size", "leader", "last", "total"]
    buckets = hits.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size"),
        F.min("node").alias("leader"),
        F.max("node").alias("last"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("total"),
        F.sum("shingles").alias("weight"),
    )
    once = buckets.where("size > 1").groupBy(*same).agg(
        F.min("bucket").alias("bucket"), F.first("weight").alias("weight")
    )
    parts = F.greatest(
        F.ceil(F.col("size") / F.lit(BLOCK)), F.ceil(F.col("weight") / F.lit(BLOCK_SHINGLES))
    )
    once = staged(once.select("bucket", "leader", parts.cast("int").alias("parts")), "buckets")
    return staged(hits.select("node", "bucket").join(once, "bucket"), "members")


def part_of(node: Column, parts: Column) -> Column:
    return F.pmod(F.xxhash64(node), parts).cast("int")


def near_leaders(members: DataFrame) -> DataFrame:
    """(bucket, part, several, leads, node): members in their parts, the leader in each of them."""
    alone = F.array(part_of(F.col("node"), F.col("parts")))
    leads = F.col("node") == F.col("leader")
    places = F.when(leads, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(alone)
    several = (F.col("parts") > 1).alias("several")
    return members.select("bucket", F.explode(places).alias("part"), several, leads.alias("leads"), "node")


def rest_pairs(members: DataFrame, rest: DataFrame) -> DataFrame:
    """(bucket, i, part, rests, own, node): the rest, in blocks i, beside every part of its group.

    ``own`` is the part a node was compared in before, where it meets nobody new.
    """
    size = rest.groupBy("bucket").agg(F.count(F.lit(1)).alias("rest_size"))
    blocks = F.ceil(F.col("rest_size") / F.lit(BLOCK)).cast("int")
    own = part_of(F.col("node"), F.col("parts")).alias("own")
    left = rest.join(size, "bucket").join(members, ["bucket", "node"]).select(
        "bucket",
        part_of(F.col("node"), blocks).alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(True).alias("rests"),
        own,
        "node",
    )
    right = members.join(size, "bucket").select(
        "bucket",
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("i"),
        own.alias("part"),
        F.lit(False).alias("rests"),
        own,
        "node",
    )
    return left.unionByName(right)


def in_blocks(members: DataFrame, key: str, size: Column, block: int) -> DataFrame:
    """Members with their part and the pair (i, j) of parts they are compared in.

    A group of at most ``block`` members is one part. A larger one is dealt into parts of about
    that many; each pair of parts is a task of its own, so no task holds a whole large group.
    """
    parts = F.ceil(size / F.lit(block)).cast("int")
    dealt = members.withColumn("part", F.pmod(F.xxhash64(key), parts).cast("int"))
    other = F.explode(F.sequence(F.lit(0), parts - 1)).alias("other")
    return dealt.select("*", other).select(
        *members.columns,
        "part",
        F.least("part", "other").alias("i"),
        F.greatest("part", "other").alias("j"),
    )


def overlaps(owner: np.ndarray, ids: np.ndarray, counts: np.ndarray, owners: int) -> np.ndarray:
    """An upper bound of every pair's similarity, which is exact where no shingle repeats:
    the sum of max(a, b) over shared shingles by the sum of max(a, b) over all."""
    _, column, uses = np.unique(ids, return_inverse=True, return_counts=True)
    total = np.bincount(owner, counts, owners)
    shared = uses[column] > 1
    owner, column, counts = owner[shared], column[shared], counts[shared]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column, counts = owner[order], column[order], counts[order]
    both = np.zeros((owners, owners), dtype=np.float32)
    least = np.zeros((owners, owners), dtype=np.float32)
    for first in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
        a, b = np.searchsorted(column, [first, first + COLUMNS])
        who, what, n = owner[a:b], column[a:b] - first, counts[a:b]
        width = int(what.max()) + 1
        there = np.zeros((owners, width), dtype=np.float32)
        there[who, what] = 1
        if n.max() == 1:
            product = there @ there.T
            both += 2 * product
            least += product
            continue
        times = np.zeros((owners, width), dtype=np.float32)
        times[who, what] = n
        product = times @ there.T
        both += product + product.T
        below = 0
        for level in np.unique(n):  # sum of min(a, b), by steps between occurring counts
            at_least = (times >= level).astype(np.float32)
            least += (level - below) * (at_least @ at_least.T)
            below = level
    return (both - least) / np.maximum(total[:, None] + total[None, :] - least, 1e-9)


def links(table: pa.Table, threshold: float, meets) -> tuple[np.ndarray, np.ndarray]:
    """Nodes in ascending order and the local root of each, by links among the pairs that
    ``meets(left, right)`` selects."""
    node = table.column("node").to_numpy()
    lists = [table.column(c).combine_chunks() for c in ("shingles", "counts")]
    sizes = lists[0].value_lengths().to_numpy()
    ids = lists[0].flatten().to_numpy().view(np.uint64)
    counts = lists[1].flatten().to_numpy().astype(np.int64)
    owner, ends = np.repeat(np.arange(len(node)), sizes), np.concatenate([[0], np.cumsum(sizes)])
    bound = np.triu(overlaps(owner, ids, counts, len(node)), 1)
    left, right = np.nonzero(bound >= threshold - 1e-4)
    ok = meets(left, right)
    left, right = left[ok], right[ok]
    repeats = np.bincount(owner, counts > 1, len(node)) > 0
    sure = ~(repeats[left] | repeats[right]) & (bound[left, right] >= threshold + 1e-4)
    roots = local_roots(len(node), left[sure], right[sure])
    for a, b in zip(left[~sure], right[~sure]):
        if roots[a] == roots[b]:
            continue
        pair = [(ids[ends[n] : ends[n + 1]], counts[ends[n] : ends[n + 1]]) for n in (a, b)]
        if similarity(*pair) >= threshold:
            low, high = sorted((roots[a], roots[b]))
            roots[roots == high] = low
    return node, roots


def in_order(table: pa.Table) -> pa.Table:
    return table.sort_by("node").combine_chunks()


def compare_parts(groups: DataFrame, threshold: float) -> DataFrame:
    """(bucket, a, b) of parts with their leaders: edges that connect what the links within the
    part connect, and (bucket, a, null) for members of a larger group that are not connected to
    the leader."""

    def run(table: pa.Table) -> pa.Table:
        table = in_order(table)
        node, roots = links(table, threshold, lambda left, right: np.ones(len(left), dtype=bool))
        tied = np.flatnonzero(roots != np.arange(len(node)))
        a, b = [node[tied]], [pa.array(node[roots[tied]])]
        if table.column("several")[0].as_py():
            lead = np.flatnonzero(table.column("leads").to_numpy())[0]
            apart = node[roots != roots[lead]]
            a.append(apart)
            b.append(pa.nulls(len(apart), pa.int64()))
        a, bucket = np.concatenate(a), table.column("bucket")[0].as_py()
        return pa.table({"bucket": np.full(len(a), bucket), "a": a, "b": pa.concat_arrays(b)})

    return groups.groupBy("bucket", "part").applyInArrow(run, "bucket bigint, a bigint, b bigint")


def compare_rest(groups: DataFrame, threshold: float) -> DataFrame:
    """Edges (a, b) between the rest and members of other parts."""

    def run(table: pa.Table) -> pa.Table:
        table = in_order(table)
        rests, own = (table.column(c).to_numpy() for c in ("rests", "own"))
        part = table.column("part")[0].as_py()

        def meets(left, right):
            new = np.where(rests[left], own[left], own[right]) != part
            return (rests[left] != rests[right]) & new

        node, roots = links(table, threshold, meets)
        tied = np.flatnonzero(roots != np.arange(len(node)))
        tied = tied[node[tied] != node[roots[tied]]]
        return pa.table({"a": node[tied], "b": node[roots[tied]]})

    return groups.groupBy("bucket", "i", "part").applyInArrow(run, "a bigint, b bigint")


def connections(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Edges (a, b) whose components are the classes of near copies."""
    first = staged(compare_parts(near_leaders(members).join(sets, "node"), threshold), "links")
    edges = first.where("b IS NOT NULL").select("a", "b")
    rest = first.where("b IS NULL").select("bucket", F.col("a").alias("node"))
    if rest.isEmpty():
        return edges
    more = compare_rest(rest_pairs(members, rest).join(sets, "node"), threshold)
    return edges.unionByName(more)


def content_classes(rows: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """(content, doc, class_id, leading), staged: the smallest id of each text and of its class,
    and whether it is the text that leads the class."""
    texts = rows.groupBy("content").agg(
        F.min("doc_id").alias("doc"), F.first("bands").alias("bands"), F.first("shingles").alias("shingles")
    )
    texts = staged(texts.withColumn("node", F.monotonically_increasing_id()), "contents")
    members = groups_to_compare(texts.where("bands IS NOT NULL"))
    wanted = members.select("node").distinct().join(texts.select("node", "content", "doc"), "node")
    held = docs.select(
        docs["doc_id"].cast("long").alias("id"), content(docs), docs["text"].cast("string").alias("text")
    )
    same = (held["content"] == wanted["content"]) & held["id"].eqNullSafe(wanted["doc"])
    texts_of = held.join(wanted, same).select("node", "text").dropDuplicates(["node"])
    sets = staged(shingle_sets(texts_of), "shingles")
    linked = components(connections(members, sets, threshold)).withColumnRenamed("id", "node")
    names = texts.select("node", "content", "doc")
    tied = staged(names.join(linked, "node"), "linked")
    order = F.struct(F.col("doc").isNull().alias("absent"), "doc", "node")
    best = tied.groupBy("component").agg(F.min(order).alias("best"))
    best = best.select("component", F.col("best.doc").alias("class_id"), F.col("best.node").alias("lead"))
    classed = tied.join(best, "component").select(
        "content", "doc", "class_id", (F.col("node") == F.col("lead")).alias("leading")
    )
    alone = names.join(linked, "node", "left_anti").select(
        "content", "doc", F.col("doc").alias("class_id"), F.lit(True).alias("leading")
    )
    return staged(classed.unionByName(alone), "classes")


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, class_id, leads.

    ``class_id`` is the smallest id among the documents connected to this one by links of at
    least ``threshold``; ``leads`` marks one row of each class, which has that id.
    """
    rows = staged(sketch(docs), "sketch")
    named = content_classes(rows, docs, threshold)
    counted = rows.groupBy("content", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    leads = F.col("leading") & F.col("doc_id").eqNullSafe(F.col("class_id"))
    copies = F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: leads & (i == 1))
    return counted.join(named, "content").select(
        "doc_id", "class_id", F.explode(copies).alias("leads")
    )


def leaders(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class with all its columns: the one whose id names the class."""
    named = content_classes(staged(sketch(docs), "sketch"), docs, threshold)
    leading = named.where("leading").select("content")
    packed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        content(docs),
        docs["doc_id"].cast("long").alias("id"),
    )
    order = Window.partitionBy("content").orderBy(F.col("id").asc_nulls_last())
    first = packed.withColumn("place", F.row_number().over(order)).where("place = 1")
    return first.join(leading, "content", "left_semi").select("row.*")
