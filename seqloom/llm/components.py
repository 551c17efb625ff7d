"""Connected components of an edge table, by alternating large-star and small-star steps.

Edges point from the greater node to the less. A step re-links only what must move: nodes that are the
lesser end of one edge and the greater end of another (large star), and nodes with several lesser
neighbours (small star). Both tables come from partial aggregations and are broadcast when they are small,
so a star of any size meets in no single task; beyond that size the joins are plain ones, whose large
partitions Spark may split. When both are empty every edge points to its component's least node. The
number of steps grows with the logarithm of the longest chain.

Before the first step and after each small star every task replaces the edges that it has by stars around the
least nodes that they reach (``contracted``), at any size: chains within a task need no steps, and where one task
has all edges, the first step finds nothing left to move. A task holds so many nodes and then begins anew, which costs
steps, never links.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import cut, drop

#: Rows (two longs each) of a table of nodes that is broadcast at most.
MOST_BROADCAST = 50_000
#: Nodes that a task holds at a time while it contracts edges.
MOST_HELD = 500_000


def small(nodes: DataFrame) -> tuple[DataFrame, int]:
    """A table to join with, marked for broadcast if it is small, and its number of rows."""
    n = nodes.count()
    return (F.broadcast(nodes) if n <= MOST_BROADCAST else nodes), n


def contracted(edges: DataFrame, most: int = MOST_HELD) -> DataFrame:
    """Edges (u, v), v the least node that u reaches by the edges held with it; what was connected stays so. May repeat rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}

        def top(c: int) -> int:
            while (up := above.get(c, c)) != c:
                above[c] = above.get(up, up)
                c = up
            return c

        def stars() -> pa.RecordBatch:
            nodes = list(above)
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([top(c) for c in nodes], pa.int64())], ["u", "v"])

        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = top(u), top(v)
                if a != b:
                    above[max(a, b)] = min(a, b)
            if len(above) > most:
                yield stars()
                above.clear()
        yield stars()

    return edges.select("u", "v").mapInArrow(run, "u long, v long")


def components(edges: DataFrame, most_steps: int = 60) -> DataFrame:
    """edges (u, v) of longs, any direction, repeats allowed -> (node, root): root is the least node of its component.

    Nodes without an edge to another are not in the result.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = cut(contracted(edges))
    for _ in range(most_steps):
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        middle = cut(least.join(edges.select(F.col("v").alias("w")).distinct(), F.col("u") == F.col("w")).select("w", "m"))
        other, moved = small(middle)
        large = edges
        if moved:
            large = cut(edges.join(other, F.col("v") == F.col("w"), "left").select("u", F.coalesce("m", "v").alias("v")).distinct())
            drop(edges)
        several = cut(large.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("x")).where("m < x").select(F.col("u").alias("w"), "m"))
        other, split = small(several)
        edges = large
        if split:
            met = large.join(other, F.col("u") == F.col("w"), "left").select("u", "v", F.coalesce("m", "v").alias("m"))
            both = F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
            edges = cut(contracted(met.select(both.alias("e")).select("e.u", "e.v").where("u <> v").distinct()))
            drop(large)
        drop(middle, several)
        if not moved and not split:
            roots = edges.select("v").distinct()
            return edges.distinct().select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
    raise RuntimeError("the components did not settle")
