"""Connected components of links held in frames."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lethe.llm.tables import written

BLOCK = 500_000  # nodes whose links a partition contracts at once


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): its smallest reachable node.

    Every partition first replaces its links by stars of what they connect, block by
    block.  Then star contraction: every round points the larger neighbours of a node to its
    smallest one, then its smaller neighbours too, until only stars are left; the
    number of rounds grows with the logarithm of the longest path.  Minima are
    aggregated on the map side and joined back, so a node with very many links
    is no single group; links with a null end and loops are ignored.
    """
    links = links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    stars = links.mapInArrow(_local_stars, "u long, v long")
    state, n = _counted(stars.distinct())
    while n and not _all_stars(state):
        state, n = _counted(_small_star(_large_star(state)), n)  # never more edges than before
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    def stars() -> pa.RecordBatch:
        ends = [(x, top) for x in parent if (top := root(x)) != x]
        u, v = zip(*ends, strict=True) if ends else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > BLOCK:
            yield stars()
            parent.clear()
    yield stars()


def _counted(edges: DataFrame, most: int | None = None) -> tuple[DataFrame, int]:
    """The edges behind a written table, and their number."""
    watch = Observation()
    table = written(edges.observe(watch, F.count(F.lit(1)).alias("n")), most)
    return table, watch.get["n"]


def _all_stars(edges: DataFrame) -> bool:
    """Does every node that points anywhere point to one node, which points nowhere?"""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    seen = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return seen.where("out > 1 or (out > 0 and into > 0)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    joined = both.where(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("w"))
    return joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    joined = edges.join(least, F.col("u") == F.col("w"))
    moved = joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct()
