"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import cut_lineage

#: A node's links are spread over this many join keys, so that a hub does not fill one task.
SALTS = 8


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest node reachable from each of the nodes 0 to n - 1 over the links a-b."""
    root = np.arange(n)
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            return root
        np.minimum.at(root, high[apart], low[apart])
        while True:
            further = root[root]
            if (further == root).all():
                break
            root = further


def _least(pairs: DataFrame) -> DataFrame:
    """``pairs`` (u, v) with ``m``, the smallest v of each u."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    salt: Column = F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")
    copies = F.explode(F.array(*[F.lit(i) for i in range(SALTS)]))
    return pairs.withColumn("salt", salt).join(least.withColumn("salt", copies), ["u", "salt"]).select("u", "v", "m")


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = _least(both).filter("v > u")
    return found.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these. ``links`` have u > v."""
    found = _least(links)
    near = found.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.union(found.select("u", F.col("m").alias("v"))).filter("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of ``links`` but the smallest of each component.

    ``links`` has two long columns without nulls; the component is the smallest node reachable. A
    node without links, or linked to itself alone, has no row. Each round is written to the checkpoint folder; the rounds
    end when every node hangs on its component directly. Links repeated or given both ways are one.
    """
    a, b = (F.col(c) for c in links.columns)
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct()
    links = cut_lineage(links)
    seen = None
    while True:
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == seen:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = state
        links = cut_lineage(_small_star(_large_star(links)))
