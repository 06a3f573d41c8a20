"""Connected components of a graph given as pairs, by alternating star contractions.

Every partition first contracts its own pairs to stars (union-find over that
partition's rows only), then large-star and small-star rounds move every node to
the smallest neighbour until nothing changes. Minima are combined before each
shuffle; rounds are written to the shared folder, so lineage stays short.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm import common


class Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while (p := up.get(root, root)) != root:
            root = p
        while x != root:
            up[x], x = root, up.get(x, x)
        return root

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        if a > b:
            a, b = b, a
        self.up[b] = a
        self.up.setdefault(a, a)
        return True


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(a, b)
    nodes = [x for x in forest.up if forest.find(x) != x]
    roots = [forest.find(x) for x in nodes]
    for i in range(0, len(nodes), 50_000):
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[i : i + 50_000], pa.int64()), pa.array(roots[i : i + 50_000], pa.int64())], ["u", "v"]
        )


def contract(pairs: DataFrame) -> DataFrame:
    """The same components with at most one pair for each node and partition; u > v."""
    return pairs.mapInArrow(_local, "u long, v long")


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    both = pairs if not large else pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    moved = both.join(low, "u")
    if large:
        moved = moved.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    return moved.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """node, root (smallest of its component) of every node that is not itself the root."""
    now = common.stage(contract(pairs.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u != v")), "pairs")
    mark = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.countDistinct("u")).first()
        if tuple(state) == mark:
            break
        mark = tuple(state)
        now = common.stage(_star(_star(now, large=True), large=False), "pairs")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
