"""Connected components of an edge list, without collecting any of it."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every end of an edge (a, b): the smallest id it is connected to.

    Edges are turned into stars step by step: every node hands its larger neighbours, then its
    smaller ones, to the smallest node it sees. The number of steps grows with the logarithm of
    the longest chain. The minima are written before they are joined, so both sides of each
    join are plain shuffles and adaptive execution splits a node with very many neighbours.
    """
    ordered = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    stars, before = staged(ordered.distinct(), "edges"), None
    while (now := fingerprint(stars)) != before:
        before = now
        both = stars.unionAll(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low"))
        least = staged(least.select("a", F.least("a", "low").alias("low")), "large-star")
        larger = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), "low")
        larger = staged(larger.where("a <> low").distinct(), "larger")
        low = staged(larger.groupBy("a").agg(F.min("low").alias("least")), "small-star")
        pairs = larger.join(low, "a")
        nodes = low.select("a", F.col("least").alias("b"))
        others = pairs.where("low <> least").select(F.col("low").alias("a"), F.col("least").alias("b"))
        stars = staged(nodes.unionAll(others).distinct(), "edges")
    roots = stars.select(F.col("b").alias("id")).distinct()
    return stars.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(
        roots.select("id", F.col("id").alias("component"))
    )


def fingerprint(stars: DataFrame) -> tuple:
    """Changes whenever the set of edges does."""
    row = stars.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def local_roots(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``count`` positions, the lowest position it is linked to inside one task."""
    root = np.arange(count)
    while True:
        low = root.copy()
        np.minimum.at(low, left, root[right])
        np.minimum.at(low, right, root[left])
        low = low[low]
        if (low == root).all():
            return root
        root = low
