"""Connected components of an edge table ``(a, b)`` of integer ids."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import materialise

EDGES_PER_GROUP = 50_000


def _union_find(edges: pd.DataFrame) -> pd.DataFrame:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(edges["a"].tolist(), edges["b"].tolist()):
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    nodes = list(parent)
    return pd.DataFrame({"id": nodes, "component": [root(n) for n in nodes]})


def components_by_star(edges: DataFrame) -> DataFrame:
    """``(id, component)`` with the lowest id as component, by alternating star contraction.

    Every step is an aggregate with partial sums and an equi-join, so one vertex may hold any share
    of the edges. Each round is written to the shared folder, and the rounds grow with the logarithm
    of the longest path.
    """
    current = materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = current.union(current.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.filter("b > a").join(low, "a").select(F.col("low").alias("a"), "b")
        large = large.filter("a <> b").distinct()
        # now the lower end is a candidate centre; link all lower neighbours of a vertex to the lowest
        least = large.groupBy("b").agg(F.min("a").alias("low"))
        small = large.join(least, "b").select(
            F.col("low").alias("a"), F.when(F.col("a") == F.col("low"), F.col("b")).otherwise(F.col("a")).alias("b")
        )
        current = materialise(small.filter("a <> b").distinct(), "edges")
        state = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    members = current.select(F.col("b").alias("id"), F.col("a").alias("component"))
    return members.union(current.select(F.col("a").alias("id"), F.col("a").alias("component"))).distinct()


def connected_components(edges: DataFrame, group: str, limit: int = EDGES_PER_GROUP) -> DataFrame:
    """``(id, component)`` of edges that never leave their ``group``.

    Groups with at most ``limit`` edges are solved inside one task each. Larger groups, if there are
    any, go through the distributed contraction, so no task ever holds more than ``limit`` edges of a
    group. ``edges`` is read several times: pass a written table.
    """
    sizes = edges.groupBy(group).agg(F.count(F.lit(1)).alias("edges"))
    large = sizes.filter(F.col("edges") > limit).select(group)

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        return _union_find(frame)

    schema = "id long, component long"
    if large.isEmpty():
        return edges.select(group, "a", "b").groupBy(group).applyInPandas(solve, schema)
    small = edges.join(large, group, "left_anti").select(group, "a", "b").groupBy(group).applyInPandas(solve, schema)
    return small.unionByName(components_by_star(edges.join(large, group, "left_semi").select("a", "b")))


