"""Connected components: contraction within bounded partitions, then alternating star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.scratch import Scratch
from larder.llm.text import lean

#: Links that one task contracts.
LOCAL = 200_000


class Forest:
    """Union-find whose roots are the smallest nodes."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        path = []
        while self.up.get(x, x) != x:
            path.append(x)
            x = self.up[x]
        for y in path:
            self.up[y] = x
        return x

    def join(self, a: int, b: int) -> bool:
        """Whether the two were apart."""
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


@lean
def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of one partition -> a link from each of their nodes to the smallest node it reaches there."""
    forest = Forest()
    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            forest.join(u, v)
    nodes = list(forest.up)
    for k in range(0, len(nodes), 100_000):
        some = nodes[k : k + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(map(forest.root, some), pa.int64())], names=["u", "v"])


def connected(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for all nodes of edges (a, b); component is the smallest node reachable.

    Each round deals the links to as many partitions as hold LOCAL links each, and
    contracts each partition to stars. One partition is the end. Else a
    large-star and a small-star step (Kiveris et al., Connected components in
    MapReduce and beyond, 2014) join the stars of different partitions; their
    groups are reduced to a minimum before the equi join, so AQE can split a hub.
    Self links and repeated links do no harm; no links give no rows.
    """
    now = scratch.keep(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    state = None
    while True:
        n, check = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        parts = max(1, -(-n // LOCAL))
        if (n, check) == state:
            break
        state = (n, check)
        local = (now.repartition(parts, "v") if parts > 1 else now.coalesce(1)).mapInArrow(_contract, "u long, v long")
        if parts == 1:
            now, old = scratch.keep(local), now
            scratch.drop(old)
            break
        stars = scratch.keep(local.distinct())
        both = stars.union(stars.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = scratch.keep(small.union(low.withColumnRenamed("m", "v")).distinct())
        scratch.drop(now, stars)
        now = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
