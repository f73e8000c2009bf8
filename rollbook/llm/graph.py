"""Connected components of links, and the assignment of highest weight."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.session import big, cut


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node in ``links`` (``a, b``); a component is named by its smallest node.

    Large and small stars in turn: every node's larger neighbours, then its smaller
    ones, are linked to its smallest neighbour, until nothing changes. Smallest
    neighbours are aggregated before the shuffle, so a node with any share of the
    links is no burden; rounds grow with the logarithm of a component's size.
    """
    nodes = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    edges = cut(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        # Large star: smallest neighbour of each node, smaller or larger.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        larger = both.where("v > u").join(big(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(larger.where("u != v").distinct())
        # Small star: smallest among the smaller neighbours.
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        met = edges.join(big(least), "u")
        smaller = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(met.select("u", F.col("m").alias("v")))
        edges = cut(smaller.where("u != v").distinct())
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if now == before:
            break
        before = now
    return nodes.join(big(edges.select(F.col("u").alias("node"), F.col("v").alias("m"))), "node", "left").select(
        "node", F.coalesce("m", "node").alias("component")
    )


def best_assignment(weight: np.ndarray) -> list[tuple[int, int]]:
    """The one-to-one pairs (row, column) of positive weight with the highest total: shortest augmenting paths with potentials."""
    n, m = weight.shape
    if not n or not m:
        return []
    if n > m:
        return [(i, j) for j, i in best_assignment(weight.T)]
    if n == 1:
        j = int(weight[0].argmax())
        return [(0, j)] if weight[0, j] > 0 else []
    cost = weight.max() - weight
    rows, columns = np.zeros(n + 1), np.zeros(m + 1)
    owner = np.zeros(m + 1, int)  # row of each column, 0 for none; column 0 is the start of a path
    for i in range(1, n + 1):
        owner[0] = i
        at = 0
        least = np.full(m + 1, np.inf)
        came = np.zeros(m + 1, int)
        done = np.zeros(m + 1, bool)
        while True:
            done[at] = True
            row = owner[at]
            free = np.nonzero(~done[1:])[0] + 1
            gap = cost[row - 1, free - 1] - rows[row] - columns[free]
            better = gap < least[free]
            least[free[better]] = gap[better]
            came[free[better]] = at
            nearest = free[np.argmin(least[free])]
            step = least[nearest]
            rows[owner[done]] += step
            columns[done] -= step
            least[free] -= step
            at = nearest
            if owner[at] == 0:
                break
        while at:
            owner[at] = owner[came[at]]
            at = came[at]
    return [(int(owner[j]) - 1, j - 1) for j in range(1, m + 1) if owner[j] and weight[owner[j] - 1, j - 1] > 0]
