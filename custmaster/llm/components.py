"""Connected components of edges that lie in tables, and the roots of a few in memory."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custmaster.llm.common import materialise

SALTS = 8


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least connected node of each of n nodes, for edges (a, b)."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        for at in (root[a], root[b], a, b):
            np.minimum.at(root, at, low)
        root = root[root]
        if (root == before).all():
            break
    while (root[root] != root).any():
        root = root[root]
    return root


def _salt(col: str) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(SALTS))


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Edges (a, b) with the column m of least (a, m): a node with very many edges meets its
    row in ``SALTS`` places, dealt by its neighbours."""
    spread = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    return edges.withColumn("salt", _salt("b")).join(spread, ["a", "salt"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of edges (a, b): the least node connected with each.

    Rounds of large-star and small-star over written tables until nothing changes.  Both
    stars combine before their shuffle and join salted, so that no hub meets in one task."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialise(edges, "edges")
    before = None
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (_with_least(both.where("b > a"), least)
                 .select(F.col("b").alias("a"), F.least("m", "a").alias("b")).where("a <> b"))
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _with_least(large, down).select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = materialise(small.select("e.a", "e.b").where("a <> b").distinct(), "edges")
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before:
            return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = after
