"""Connected components: inside a task with numpy, over tables with star contractions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of n nodes over the links a[i] - b[i]."""
    label = np.arange(n)
    while len(a):
        x, y = label[a], label[b]
        lo, hi = np.minimum(x, y), np.maximum(x, y)
        open_ = lo != hi
        if not open_.any():
            break
        a, b = a[open_], b[open_]
        np.minimum.at(label, hi[open_], lo[open_])
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
    return label


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(least, "u").filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them (u > v in every edge)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label): the smallest node of each linked node's component.

    Large-star and small-star rounds alternate until the edges no longer change; every round
    is a written table, so a lost executor repeats one round at most. The edges are then
    one star per component."""
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    edges = written(edges, "components")
    seen = None
    for _ in range(max_rounds):
        # A hash of the set of edges; it repeats only when a round changes nothing.
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state["n"] == 0 or state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        seen = state
        edges = written(_small_star(_large_star(edges)), "components")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
