"""Connected components of an edge table, without collecting anything."""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import cut

#: Where the tables of a round are kept until it ends.
KEPT = StorageLevel.DISK_ONLY
#: Links that a node of a task's forest has to nodes after it, at most.
FAN = 16


def forest(nodes: np.ndarray, roots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that connect the nodes of each root: a tree of small degree, so that no node is a hub.

    The first node of a tree is linked to itself.
    """
    order = np.lexsort((nodes, roots))
    nodes, roots = nodes[order], roots[order]
    first = np.flatnonzero(np.r_[True, roots[1:] != roots[:-1]]) if len(nodes) else np.zeros(0, dtype=np.int64)
    start = np.repeat(first, np.diff(np.r_[first, len(nodes)]))
    place = np.arange(len(nodes)) - start
    return nodes, nodes[start + np.maximum(place - 1, 0) // FAN]


def connected_components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for every node of ``edges`` (a, b).

    Minimum labels spread over the edges, and each round shortens the paths by
    following labels of labels, so long chains need logarithmically many rounds.
    Rounds go on until nothing changes; ``rounds`` only guards against a fault, and
    reaching it raises an error. Each round ends with a checkpoint in the shared
    folder; within a round, blocks are kept on disk with their lineage, so that
    those of a lost executor are computed anew.
    """
    ends = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    both = cut(edges.where("a <> b").select(ends.alias("e")).select("e.a", "e.b").distinct())
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root"))
    if both.isEmpty():
        return labels
    for _ in range(rounds):
        spread = (
            both.join(labels.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        nearer = labels.join(spread, "node").select("node", "root", F.least("root", "near").alias("new")).persist(KEPT)
        # The old root takes over the best label that any of its followers found.
        hook = nearer.groupBy(F.col("root").alias("node")).agg(F.min("new").alias("hook"))
        hooked = nearer.join(hook, "node", "left").select("node", "root", F.least("new", "hook").alias("new")).persist(KEPT)
        jump = hooked.select(F.col("node").alias("new"), F.col("new").alias("far"))
        after = cut(hooked.join(jump, "new", "left").select("node", "root", F.least("new", "far").alias("new")))
        hooked.unpersist()
        nearer.unpersist()
        changed = after.where("root <> new").limit(1).count()
        labels = after.select("node", F.col("new").alias("root"))
        if not changed:
            return labels
    raise RuntimeError("components did not settle")
