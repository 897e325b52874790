"""Connected components of a graph that no task has to hold."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainledger.llm.common import stored

MAX_ROUNDS = 60


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same components as ``a``-``b``, at most one per node: each node with its component's smallest."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inverse[: len(a)], inverse[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, before[x], low)
        np.minimum.at(root, before[y], low)
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        root = root[root]
        if (root == before).all():
            break
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[root[moved]], nodes[moved]


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest node around it, itself included."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")), "least")
    return (
        both.where("b > a").join(least, "a").select(F.col("least").alias("a"), "b").where("a <> b").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    least = stored(edges.groupBy("b").agg(F.min("a").alias("least")), "least")
    joined = edges.join(least, "b")
    smaller = joined.where("a <> least").select(F.col("least").alias("a"), F.col("a").alias("b"))
    return smaller.unionAll(least.select(F.col("least").alias("a"), "b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b`` long); the root is the component's smallest node.

    Alternating large and small stars (Kiveris et al.), which end when each component is a star; a path of n nodes takes
    some log n rounds. A node's neighbours are only aggregated and joined, never gathered; as the
    minima are tables of their own, Spark can split the join of a node with very many. Each
    round is written to the shared folder, so lost executors do not set it back.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = stored(links.select(low.alias("a"), high.alias("b")).where("a <> b").distinct(), "links")
    state = None
    for _ in range(MAX_ROUNDS):
        edges = stored(_small_star(stored(_large_star(edges), "stars")), "stars")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("the components did not settle")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionAll(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
