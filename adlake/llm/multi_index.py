"""Near-duplicate vectors through an inverted multi-index.

Each half of the unit vectors has its own codebook; the product of the two is a grid of cells. A
vector lives in the cell of its nearest centroids and visits others in the order of the summed
distances of their halves (multi-sequence traversal), until their cost exceeds its own cell's by
``slack``. The slack is learned so that a partner at exactly the threshold, in a random
direction, lives in a visited cell with probability ``recall``; nearer partners are found more
often, and a pair has two chances, from either side. Meeting in a cell, pairs are verified by
their cosine in double precision. Every vector is indexed; only codebooks and slack come from a
sample of at most about ``sample`` vectors, or 16 for each centroid where those are more.

Vectors link only within equal labels and dimensions. Null labels, null, empty or zero vectors
and vectors with null or non-finite components link with nothing and stay alone. Equal vectors
are one member with a number of copies, which all link with each other. Members are numbered, so
one id may stand on several vectors and each row has the links of its own vector. A null id links
like any other and never names a component that has an id. Repeated rows count as copies. An
empty table gives an empty result; extra columns are not read.

No pair is ever a row: a task compares the members of one cell by matrix products and returns
for each member how many others it is linked to and whom it is connected to. A cell with many
members is compared block by block, so that no task holds a whole large cell.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import staged
from adlake.llm.graph import components, local_roots
from adlake.llm.minhash import in_blocks

THRESHOLD = 0.98
RECALL = 0.995
SAMPLE = 8_192
#: Members of the largest label a cell should have on average, which sets the grid's size.
CELL_MEMBERS = 48
#: Sampled members of a centroid at least, where that asks for more than ``sample``: the number of
#: centroids, and with it the sample, grows with the root of the largest label.
SAMPLED_MEMBERS = 16
BLOCK = 2_048


@dataclass(frozen=True)
class Grid:
    """Codebooks of the two halves of unit vectors and the traversal's slack."""

    first: np.ndarray
    second: np.ndarray
    slack: float

    @property
    def cells(self) -> int:
        return len(self.first) * len(self.second)


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (x**2).sum(1)[:, None] - 2 * x @ centroids.T + (centroids**2).sum(1)


def codebook(x: np.ndarray, size: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's k-means from evenly spaced members of the sample."""
    centroids = x[np.linspace(0, len(x) - 1, size).astype(int)].copy()
    for _ in range(rounds):
        near = squared(x, centroids).argmin(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, x)
        sizes = np.bincount(near, minlength=size)
        centroids[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centroids


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = (x.shape[1] + 1) // 2
    return x[:, :cut], x[:, cut:]


def build(sample: np.ndarray, centroids: int, threshold: float, recall: float) -> Grid:
    """Codebooks of the unit vectors in ``sample`` and the slack for the wanted recall."""
    a, b = halves(sample)
    size = max(1, min(centroids, len(sample)))
    grid = Grid(codebook(a, size), codebook(b, size), 0.0)
    noise = np.random.default_rng(7).standard_normal(sample.shape)
    noise -= (noise * sample).sum(1)[:, None] * sample
    noise /= np.maximum(np.linalg.norm(noise, axis=1), 1e-12)[:, None]
    partners = threshold * sample + np.sqrt(max(0.0, 1 - threshold**2)) * noise
    extra = np.zeros(len(sample))
    for x, y, c in zip(halves(sample), halves(partners), (grid.first, grid.second)):
        cost = squared(x, c)
        home = squared(y, c).argmin(axis=1)
        extra += cost[np.arange(len(x)), home] - cost.min(axis=1)
    return Grid(grid.first, grid.second, float(np.quantile(extra, recall)) + 1e-9)


def traverse(near_a: np.ndarray, near_b: np.ndarray, slack: float) -> list[int]:
    """Cells in ascending order of summed cost, from one vector's costs to both codebooks."""
    order_a, order_b = np.argsort(near_a, kind="stable"), np.argsort(near_b, kind="stable")
    a, b = near_a[order_a].tolist(), near_b[order_b].tolist()
    stop, heap, pushed, cells = a[0] + b[0] + slack, [(a[0] + b[0], 0, 0)], {(0, 0)}, []
    while heap and heap[0][0] <= stop:
        _, i, j = heapq.heappop(heap)
        cells.append(int(order_a[i]) * len(b) + int(order_b[j]))
        for n, m in ((i + 1, j), (i, j + 1)):
            if n < len(a) and m < len(b) and (n, m) not in pushed:
                pushed.add((n, m))
                heapq.heappush(heap, (a[n] + b[m], n, m))
    return cells


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1)[:, None]


def matrix(column: pa.ChunkedArray | pa.Array, dimension: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def members_of(vectors: DataFrame) -> DataFrame:
    """(label, embedding, rep, copies, node), staged: the different vectors that can link, their
    smallest id, and a number that tells them apart whatever their ids."""
    values = F.col("embedding")
    fine = F.forall(
        values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    ) & F.exists(values, lambda v: v != 0)
    usable = vectors.where("label IS NOT NULL AND embedding IS NOT NULL").where(fine)
    different = usable.groupBy("label", "embedding").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")
    )
    return staged(different.withColumn("node", F.monotonically_increasing_id()), "vectors")


def make_grids(members: DataFrame, threshold: float, recall: float, sample: int) -> dict[int, Grid]:
    """A grid for each dimension, from members whose hash falls below the wanted share."""
    labels = members.groupBy(F.size("embedding").alias("d"), "label").count()
    sizes = labels.groupBy("d").agg(F.sum("count").alias("n"), F.max("count").alias("most"))
    grids = {}
    for row in sizes.collect():
        centroids = max(1, round(np.sqrt(row["most"] / CELL_MEMBERS)))
        share = min(1.0, max(sample, SAMPLED_MEMBERS * centroids) / row["n"])
        chosen = F.pmod(F.xxhash64("embedding"), F.lit(1 << 30)) < int(share * (1 << 30))
        part = members.where((F.size("embedding") == row["d"]) & chosen)
        rows = part.orderBy("rep", "label", "embedding").select("embedding").toArrow()
        if not rows.num_rows:
            rows = members.where(F.size("embedding") == row["d"]).limit(1).select("embedding").toArrow()
        found = unit(matrix(rows.column("embedding"), row["d"]))
        grids[row["d"]] = build(found, centroids, threshold, recall)
    return grids


def visits(members: DataFrame, grids: dict[int, Grid]) -> DataFrame:
    """One row per member and visited cell; ``cells`` are all it visits, its home first."""

    def run(batches):
        for batch in batches:
            sizes = batch.column("d").to_numpy()
            for d in np.unique(sizes):
                rows = pa.RecordBatch.from_struct_array(
                    batch.to_struct_array().filter(pa.array(sizes == d))
                )
                grid = grids[int(d)]
                a, b = halves(unit(matrix(rows.column("embedding"), int(d))))
                costs = zip(squared(a, grid.first), squared(b, grid.second))
                cells = [traverse(x, y, grid.slack) for x, y in costs]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(cells, pa.list_(pa.int32()))],
                    [*rows.schema.names, "cells"],
                )

    named = members.select("label", "embedding", "node", "copies", F.size("embedding").alias("d"))
    schema = named.select("*", F.array(F.lit(0)).alias("cells")).schema
    return named.mapInArrow(run, schema).select("*", F.explode("cells").alias("cell"))


def compare(table: pa.Table, threshold: float) -> pa.Table:
    """Links among one cell's residents and between them and its visitors.

    A pair that meets in both its homes counts in the lower cell. Between two blocks only
    pairs across them count.
    """
    d, cell = table.column("d")[0].as_py(), table.column("cell")[0].as_py()
    node, part = table.column("node").to_numpy(), table.column("part").to_numpy()
    copies = table.column("copies").to_numpy()
    cells = table.column("cells").combine_chunks()
    starts, flat = cells.offsets.to_numpy(), cells.flatten().to_numpy()
    starts = starts - starts[0]
    home = flat[starts[:-1]]
    x = matrix(table.column("embedding"), d)
    norms = np.linalg.norm(x, axis=1)
    here = np.flatnonzero(home == cell)
    cosine = (x @ x[here].T) / (norms[:, None] * norms[here])
    left, right = np.nonzero(cosine >= threshold)
    right = here[right]
    if table.column("i")[0].as_py() != table.column("j")[0].as_py():
        ok = part[left] != part[right]
        left, right = left[ok], right[ok]
    resident = home[left] == cell
    owner = np.repeat(np.arange(len(node)), np.diff(starts))
    visited = np.isin(right * (flat.max() + 1) + home[left], owner * (flat.max() + 1) + flat)
    once = np.where(resident, left < right, ~visited | (home[left] > cell))
    left, right = left[once], right[once]
    links = np.bincount(left, copies[right], len(node)) + np.bincount(right, copies[left], len(node))
    order = np.argsort(node, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    roots = node[order][local_roots(len(node), place[left], place[right])][place]
    some = np.flatnonzero(links > 0)
    return pa.table(
        {"node": node[some], "root": roots[some], "links": links[some].astype(np.int64)}
    )


def link(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows = vectors.select("vec_id", "label", "embedding")
    members = members_of(rows)
    grids = make_grids(members, threshold, recall, sample)
    met = staged(visits(members, grids), "visits")
    sizes = met.groupBy("label", "d", "cell").agg(F.count(F.lit(1)).alias("size"))
    same = ["label", "d", "cell"]
    dealt = in_blocks(met.join(staged(sizes, "cells"), same), "node", F.col("size"), BLOCK)
    found = staged(
        dealt.groupBy(*same, "i", "j").applyInArrow(
            lambda table: compare(table, threshold), "node bigint, root bigint, links bigint"
        ),
        "links",
    )
    linked = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    linked = staged(linked.withColumnRenamed("id", "node").join(members.select("node", "rep"), "node"), "linked")
    names = linked.groupBy("component").agg(F.min("rep").alias("name"))
    named_nodes = linked.join(names, "component").select("node", "name")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = (
        members.join(counts, "node", "left")
        .join(named_nodes, "node", "left")
        .select(
            "label",
            "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("name", "rep").alias("component"),
        )
    )
    joined = rows.join(staged(named, "named"), ["label", "embedding"], "left")
    return joined.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component", "vec_id")).alias("kept"),
    )
