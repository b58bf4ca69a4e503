"""Connected components by rounds of star operations on a table of links."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwright.session import settle


def forest(
    size: int,
    pairs: Iterator[tuple[np.ndarray, np.ndarray]],
    alike: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
    root: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what the pairs of ``size`` members join, one less than the members of each group.

    Pairs whose ends are joined already are passed by; of the others those count that ``alike`` says.  ``root`` has the
    least member of the group of each member at the start.
    """
    root = np.arange(size) if root is None else root.copy()

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for x, y in pairs:
        apart = root[x] != root[y]
        x, y = x[apart], y[apart]
        if alike is not None and len(x):
            true = alike(x, y)
            x, y = x[true], y[true]
        if not len(x):
            continue
        for key in np.unique(root[x] * size + root[y]).tolist():
            i, j = find(key // size), find(key % size)
            if i != j:
                root[max(i, j)] = min(i, j)
                out.append((i, j))
        # All members point at the least of their group again.
        while (root[root] != root).any():
            root = root[root]
    links = np.array(out, np.int64).reshape(-1, 2)
    return links[:, 0], links[:, 1]


def _least(links: DataFrame) -> DataFrame:
    """The least of each node and its neighbours; combined before the shuffle, so a hub costs a row per task.

    Written to a table, so that the join with it deals out both sides anew and Spark can split the rows of a hub.
    """
    return settle(links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for each node of the links ``a, b``; a component is named by its least node.

    Large-star and small-star rounds (Kiveris and others, 2014): the number of rounds grows with the logarithm of the
    longest path.  Links are joined with the least neighbour of a node, never gathered at one, and each round is
    written to the shared folder.  Links to oneself and repeats are ignored; rows with a null end are not links.
    """
    table = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    table = settle(table.filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct(), "links")
    seen = None
    while True:
        # Large star: every greater neighbour is linked to the least of the neighbourhood.
        both = table.unionByName(table.select(F.col("v").alias("u"), F.col("u").alias("v")))
        star = both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = star.distinct()
        # Small star: the lesser neighbours and the node itself are linked to the least of them.
        least = _least(star)
        small = star.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        table = settle(small.filter("u <> v").distinct(), "links")
        state = table.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    ends = table.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    roots = table.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return ends.unionByName(roots)
