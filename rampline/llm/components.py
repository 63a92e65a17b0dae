"""Connected components of a graph that no single task could hold.

Large and small stars in turn (Kiveris et al., 2014): every node hands its larger, then its
smaller neighbours to the smallest node it knows, until each component is one star. A step
needs a minimum per node, combined before the shuffle, and a join with these minima. The
minima are written out before they are joined, so that both sides of the join come from
plain shuffles and Spark can split the share of a node with very many neighbours.
"""

from __future__ import annotations

import numpy as np
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from rampline.llm.common import written

MOST_ROUNDS = 100


def local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For nodes 0 to n-1 with the given links, the smallest node each one reaches."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, left, root[right])
        np.minimum.at(root, right, root[left])
        root = root[root]
        if np.array_equal(before, root):
            return root


def _ordered(edges: DataFrame) -> DataFrame:
    return (
        edges.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).where("high > low").distinct()
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("high", "low"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("high").alias("node"), F.col("low").alias("other")).union(edges.select("low", "high"))
    known = written(both.groupBy("node").agg(F.min("other").alias("least")).where("least < node"), "star")
    moved = edges.join(known, F.col("low") == F.col("node"), "left")
    return _ordered(moved.select(F.col("high").alias("a"), F.coalesce("least", "low").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    known = written(edges.groupBy("high").agg(F.min("low").alias("least")), "star").withColumnRenamed("high", "node")
    moved = edges.join(known, F.col("high") == F.col("node"))
    to_least = moved.select(F.explode(F.array("high", "low")).alias("a"), F.col("least").alias("b"))
    return _ordered(to_least)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node with a link (a, b) reaches, itself excepted."""
    edges = written(_ordered(edges), "edges")
    state = _state(edges)
    for _ in range(MOST_ROUNDS):
        edges = written(_small_star(written(_large_star(edges), "edges")), "edges")
        before, state = state, _state(edges)
        if before == state:
            return edges.select(F.col("high").alias("node"), F.col("low").alias("root"))
    raise RuntimeError("components did not settle")
