"""Connected components of an edge list by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import stored


class Forest:
    """Union-find over arbitrary integers; the least member leads."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up, root = self.up, x
        while (p := up.get(root, root)) != root:
            root = p
        while (p := up.get(x, x)) != root:
            up[x], x = root, p
        return root

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _spanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a batch without those that close a circle."""
    for batch in batches:
        forest = Forest()
        a, b = (batch.column(i).to_pylist() for i in (0, 1))
        keep = np.array([forest.union(x, y) for x, y in zip(a, b)], bool)
        yield batch.filter(pa.array(keep))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b long, not null); the least member names it.

    Rounds of large-star and small-star: every node's larger, then its smaller
    neighbours are linked to the least neighbour.  A hub's edges meet only in
    a partial minimum and in a join that Spark can split.  Each round is written,
    so a lost executor costs one round at most.
    """
    e = edges.select("a", "b").filter("a <> b").mapInArrow(_spanning, "a long, b long")
    e = stored(e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    while not _stars(e):
        # large star: larger neighbours (and the node itself, if not the least) to the least neighbour
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.filter("v > u").join(least, "u").filter("v <> m")
                 .select(F.col("m").alias("a"), F.col("v").alias("b")))
        large = stored(large, "large_star")
        # small star: smaller neighbours and the node itself to the least of them
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (large.join(least, "b").filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
                 .union(least.select(F.col("m").alias("a"), "b")).distinct())
        e = stored(small, "small_star")
    leaves = e.select(F.col("b").alias("node"), F.col("a").alias("component"))
    roots = e.select("a").distinct().select(F.col("a").alias("node"), F.col("a").alias("component"))
    return leaves.union(roots)


def _stars(e: DataFrame) -> bool:
    """Whether every node is a centre or has one edge, to its centre."""
    ends = e.select(F.col("a").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(
        e.select("b", F.lit(0), F.lit(1)))
    ends = ends.groupBy("x").agg(F.max("out").alias("out"), F.sum("into").alias("into"))
    return ends.filter("into > 1 or into = 1 and out = 1").isEmpty()
