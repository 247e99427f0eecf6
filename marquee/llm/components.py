"""Connected components of a graph given by its edges, in rounds of joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import stage


class Forest:
    """Union-find over arbitrary whole numbers; roots are the smallest members."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while self.parent.get(root, root) != root:
            root = self.parent[root]
        while self.parent.get(x, x) != root:
            self.parent[x], x = root, self.parent[x]
        return root

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        low, high = min(a, b), max(a, b)
        self.parent.setdefault(low, low)
        self.parent[high] = low


#: edges a task contracts at once
_EDGES_AT_ONCE = 500_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars with the same components as the edges of a partition."""
    forest, held = Forest(), 0

    def stars() -> pa.RecordBatch:
        nodes = [x for x, p in forest.parent.items() if forest.find(x) != x]
        return pa.record_batch(
            {"a": pa.array(nodes, pa.int64()), "b": pa.array([forest.find(x) for x in nodes], pa.int64())}
        )

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.join(a, b)
        held += batch.num_rows
        if held > _EDGES_AT_ONCE:
            yield stars()
            forest, held = Forest(), 0
    if held:
        yield stars()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); a component is
    named by its smallest node.

    Large-star and small-star rounds (Kiveris et al. 2014) until the edges are
    stars: every round is two aggregations and two joins by node, and what a
    round leaves is written, so nothing has to be computed twice. Before every
    round each task contracts the edges it holds."""
    edges = stage(edges.mapInArrow(_contract, "a long, b long").distinct(), "edges")
    state = None
    while True:
        found = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % (1 << 40)).alias("h")).first()
        if (found["n"], found["h"]) == state:
            break
        state = (found["n"], found["h"])
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("u")).where("b > a and b <> m").selectExpr("b as a", "m as b").distinct()
        # every edge now points from the larger to the smaller node
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        joined = large.join(least, F.col("a") == F.col("u"))
        small = joined.selectExpr("b as a", "m as b").where("a <> b").union(least.selectExpr("u as a", "m as b"))
        edges = stage(small.distinct(), "edges")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.selectExpr("a as node", "b as component").union(roots).distinct()


def star_edges(nodes: np.ndarray, labels: np.ndarray) -> pa.RecordBatch:
    """Edges (node, smallest node with the same label), without loops."""
    order = np.lexsort((nodes, labels))
    nodes, labels = nodes[order], labels[order]
    first = np.ones(len(nodes), bool)
    first[1:] = labels[1:] != labels[:-1]
    root = nodes[np.flatnonzero(first)[np.cumsum(first) - 1]]
    rest = ~first
    return pa.record_batch({"a": pa.array(nodes[rest], pa.int64()), "b": pa.array(root[rest], pa.int64())})
