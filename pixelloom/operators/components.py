"""Connected components of an edge table, distributed (alternating large-star and small-star rounds).

Each round is two grouped minima and two equi-joins; labels are never collected, and every
round's edges are written to shared storage, which cuts the lineage without a local copy.
The minima combine on the map side, and the edges of the largest hubs get theirs from a broadcast of
bounded size, so a node that a third of all edges share does not meet in one task; edges that are few enough for a task are joined plainly.
The number of rounds grows with the logarithm of the number of nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelloom.operators.keyed import attach
from pixelloom.sources.storage import materialise

#: Edges that one task may take, whatever their nodes.
ONE_TASK = 100_000


def _state(edges: DataFrame) -> tuple:
    """Count and order-free hash of an edge set; equal exactly when nothing has changed."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _meet(rows: DataFrame, least: DataFrame, on: str, total: int) -> DataFrame:
    """``rows`` with the minimum ``m`` of their ``on`` from ``least`` (w, m, n); ``total`` bounds the number of edges."""
    return attach(rows, least, on, "w", "n") if total > ONE_TASK else rows.join(least, F.col(on) == F.col("w"))


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"), "n")
    return _meet(both.where("v > u"), least, "u", total).where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    least = edges.groupBy(F.col("a").alias("w")).agg(F.min("b").alias("m"), F.count("*").alias("n"))
    moved = _meet(edges, least, "a", total).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("w", "m")).distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node of an edge that joins two different nodes; component is the smallest node reachable.

    Self-loops, repeated edges, both directions of an edge and edges with a null end are allowed;
    nodes without another partner do not appear.  No edges give no rows."""
    kind = edges.schema[src].dataType
    pairs = edges.select(F.col(src).alias("s"), F.col(dst).cast(kind).alias("d")).where("s <> d")
    now = materialise(pairs.select(F.greatest("s", "d").alias("a"), F.least("s", "d").alias("b")).distinct(), "edges")
    was = _state(now)
    while was[0]:
        larger = _large_star(now, was[0])  # no more edges than before
        if was[0] > ONE_TASK:
            larger = materialise(larger, "edges")  # read five times
        now = materialise(_small_star(larger, was[0]), "edges")
        state = _state(now)
        if state == was:
            break
        was = state
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("node", F.col("node").alias("component")))
