"""Connected components of a graph given by its edges: distributed union-find."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import written

EDGES_A_TASK = 1_000_000
STARS = "node bigint, root bigint"


class UnionFind:
    """Sets of the numbers 0 to n - 1, each under its smallest member."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def union(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        if y < x:
            x, y = y, x
        self.parent[y] = x
        return True


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node but the smallest of its component, with that smallest."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    sets = UnionFind(len(nodes))
    for x, y in zip(places[: len(a)].tolist(), places[len(a) :].tolist(), strict=True):
        sets.union(x, y)
    roots = np.array([sets.find(x) for x in range(len(nodes))], np.int64)
    own = np.flatnonzero(roots != np.arange(len(nodes)))
    return nodes[own], nodes[roots[own]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    found += [tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns) for batch in batches]
    node, root = stars(*(np.concatenate(side) for side in zip(*found, strict=True)))
    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["node", "root"])


def star_rounds(edges: DataFrame) -> DataFrame:
    """Large-star and small-star in turn until nothing changes. Only minima are taken of a node's
    neighbours, so no node's neighbourhood is ever gathered."""
    before = None
    while True:
        both = edges.select("node", "root").union(edges.select("root", "node"))
        least = both.groupBy("node").agg(F.min("root").alias("least"))
        least = least.select("node", F.least("node", "least").alias("least"))
        large = both.join(least, "node").filter(F.col("root") > F.col("node"))
        large = large.select(F.col("root").alias("node"), F.col("least").alias("root"))
        large = large.filter("node <> root").distinct()
        low = large.groupBy("node").agg(F.min("root").alias("least"))
        small = large.join(low, "node").select(F.col("root").alias("node"), F.col("least").alias("root"))
        small = small.union(low.select("node", "least")).filter("node <> root").distinct()
        edges = written(small, "stars")
        mark = F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))
        now = tuple(edges.agg(F.count(F.lit(1)), mark).first())
        if now == before:
            return edges
        before = now


def components(edges: DataFrame, edges_a_task: int = EDGES_A_TASK) -> DataFrame:
    """(node, root) for every node of `edges` (two bigint columns) but the roots; a root is its
    component's smallest node. Loops are no edges; nulls must not occur.

    Tasks of bounded size first contract their share of the edges; where one task holds them all
    that is the answer, else star rounds join what the tasks have found.
    """
    a, b = edges.columns
    edges = edges.select(F.col(a).alias("node"), F.col(b).alias("root")).filter("node <> root")
    edges = written(edges, "edges")
    total = edges.count()
    while total:
        tasks = math.ceil(total / edges_a_task)
        edges = written(edges.repartition(tasks).mapInArrow(_contract, STARS), "contracted")
        left = edges.count()
        if tasks == 1:
            return edges
        if left > total / 2:
            return star_rounds(edges)
        total = left
    return edges
