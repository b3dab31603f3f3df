"""Connected components of a table of edges, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.session import staged


def _downward(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller end, loops left out."""
    return (
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node of ``edges`` (a, b: long).

    Each round connects the larger neighbours of every node to its smallest neighbour, then the
    smaller ones likewise; the rounds grow with the logarithm of the longest path. Each one is
    written to the shared folder, so a lost executor costs one round, and the driver sees a count
    and a checksum only. A node with very many edges is reduced to its minimum before the
    shuffle, and its rows in the join are split by Spark as the other side has one row a node.
    """
    edges = staged(_downward(edges), "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low"))
        large = (
            both.filter("b > a")
            .join(lowest, "a")
            .select(F.col("b").alias("a"), F.least("a", "low").alias("b"))
            .distinct()
        )
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = staged(
            _downward(small.unionByName(lowest.select("a", F.col("low").alias("b")))), "edges"
        )
        last, mark = mark, _mark(edges)
        if mark == last:
            break
    roots = edges.select(F.col("b").alias("node")).distinct()
    return (
        edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        .unionByName(roots.select("node", F.col("node").alias("component")))
    )


def _mark(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
    )


def spanning(adjacent: np.ndarray) -> np.ndarray:
    """For each row of a symmetric boolean matrix, the first row of its component."""
    n = len(adjacent)
    label = np.arange(n)
    for first in range(n):
        if label[first] != first:
            continue
        reached = adjacent[first].copy()
        reached[first] = True
        edge = reached
        while True:
            grown = reached | adjacent[edge].any(axis=0)
            edge = grown & ~reached
            if not edge.any():
                break
            reached = grown
        label[reached] = first
    return label
