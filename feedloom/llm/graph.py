"""Connected components of an edge table, contracted inside tasks first."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import batch_of
from feedloom.operators.components import components_by_star
from feedloom.session import materialise

#: Edges that one task contracts.
TASK_EDGES = 500_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the task's edges: every vertex with the lowest of its component here."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    names = list(parent)
    yield batch_of(id=pa.array(names, pa.int64()), component=pa.array([root(x) for x in names], pa.int64()))


def components(edges: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """``(id, component)`` of the vertices of ``edges(a, b)``; the component is its lowest id.

    Pass a written table, it is read twice. The tasks' own components, one edge per vertex, are what goes
    through the distributed contraction; where one task holds all edges there is nothing left to join.
    """
    tasks = max(1, -(-edges.count() // task_edges))
    own = edges.select("a", "b").coalesce(tasks).mapInArrow(_contract, "id long, component long")
    own = materialise(own, "components")
    if tasks == 1:
        return own
    links = own.filter("id <> component").select(F.col("component").alias("a"), F.col("id").alias("b"))
    return materialise(components_by_star(links), "components")
