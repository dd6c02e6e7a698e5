"""Connected components of a link table by alternating large and small stars.

Each round points every node's larger neighbours at its smallest neighbour
(large star), then every node's smaller neighbours at the smallest of them
(small star), until nothing changes. Rounds grow with the logarithm of a
component's diameter; a round is two aggregations and joins of narrow rows,
written to the shared folder. A hub's links are aggregated in the map tasks
and its join is split by the skew join.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.llm.common import store


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = _both_ways(edges)
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return (down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where(F.col("u") != F.col("v")).union(least.select("u", F.col("m").alias("v"))).distinct())


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
    return r["n"], r["h"]


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link; ``component`` is its smallest node."""
    edges = store(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u") != F.col("v"))
                  .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        edges = store(_small_star(_large_star(edges)), "links")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def local_classes(near: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each node of a symmetric link matrix."""
    mark = np.arange(len(near))
    far = len(near)
    while True:
        new = np.minimum(mark, np.where(near, mark[None, :], far).min(axis=1))
        new = new[new]
        if (new == mark).all():
            return mark
        mark = new
