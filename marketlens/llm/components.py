"""Connected components of an edge table by repeated contraction to the smallest node."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from marketlens.llm.shared import Shared


def components(shared: Shared, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) but the roots; root is the smallest node.

    Each round hangs every node and its neighbours below its smallest neighbour and
    halves the paths; rounds grow with the logarithm of the longest path. Minima are
    combined before their shuffle and stored, so that both sides of the joins are shuffled
    for them and Spark can split a large star. Self loops and repeated edges are ignored; no
    edges give no rows.
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    state = shared.put(edges.filter("a <> b").select(larger, smaller).distinct())
    while True:
        lowest = shared.put(state.groupBy("a").agg(F.min("b").alias("p")))
        hung = state.join(lowest, "a").select(
            F.explode(
                F.array(
                    F.struct("a", F.col("p").alias("b"), F.lit(False).alias("moved")),
                    F.struct(F.col("b").alias("a"), F.col("p").alias("b"),
                             F.lit(True).alias("moved")),
                )
            ).alias("e")
        ).select("e.*").filter("a <> b")
        above = lowest.select(F.col("a").alias("b"), F.col("p").alias("up"))
        jumped = hung.join(above, "b", "left").select(
            "a", F.coalesce("up", "b").alias("b"),
            (F.col("moved") | F.col("up").isNotNull()).alias("moved"),
        )
        following = shared.put(jumped.groupBy("a", "b").agg(F.max("moved").alias("moved")))
        moved = following.agg(F.max("moved")).first()[0]
        shared.drop(state, lowest)
        state = following
        if not moved:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root"))


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the trees of a[i] and b[i]; every entry of the result names its root."""
    while len(a):
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    return parent
