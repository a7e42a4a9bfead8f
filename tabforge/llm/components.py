"""Connected components of a table of links: blocks contracted in tasks, joined by star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tabforge.session import cut_lineage

BLOCK = 1 << 20       # links contracted together in a task


def _minimum(edges: DataFrame) -> DataFrame:
    """Each (u, v) with the least neighbour of u; hubs only meet partial minima."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = _minimum(both).withColumn("m", F.least("m", "u")).where("v > u")
    return near.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _minimum(down)
    moved = near.select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = near.select("u", F.col("m").alias("v"))
    return moved.unionByName(kept).where("u <> v").distinct()


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a block replaced by stars: each node with its least node inside the block."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = x = parent.get(p, p)
        return x

    def stars() -> pa.RecordBatch:
        nodes = list(parent)
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(map(root, nodes), pa.int64())],
                                          names=["u", "v"])

    for b in batches:
        for u, v in zip(b.column("u").to_pylist(), b.column("v").to_pylist()):
            u, v = root(u), root(v)
            if u != v:
                parent[max(u, v)] = min(u, v)
        if len(parent) > BLOCK:
            yield stars()
            parent.clear()
    yield stars()


def _state(edges: DataFrame) -> Row:
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1000003)).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): component is the least node reachable; nodes with links only.

    ``edges``: long columns u, v, any direction, repeats allowed. Each round
    contracts blocks of at most about ``BLOCK`` links inside tasks, then joins
    the blocks by a star step; it ends when the star step changes nothing.
    Every round is written to the shared folder; the number of rounds grows
    with the logarithm of the longest path of blocks.
    """
    now = cut_lineage(edges.where("u <> v").select("u", "v"), "links")
    while True:
        blocks = -(-now.count() // BLOCK) or 1
        now = cut_lineage(now.coalesce(blocks).mapInArrow(_contract, "u long, v long"), "blocks")
        before = _state(now)
        now = cut_lineage(_small_star(_large_star(now)), "stars")
        if _state(now) == before:
            break
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(centres)
