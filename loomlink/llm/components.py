"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomlink.llm.common import stored

#: Edges that one task contracts (16 bytes each).
EDGES = 500_000


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v) for each node but the smallest of the partition's components: v is that smallest node."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            i, j = top(u), top(v)
            up.setdefault(u, u), up.setdefault(v, v)
            if i != j:
                up[max(i, j)] = min(i, j)
    pairs = np.array([(u, r) for u in list(up) if (r := top(u)) != u], np.int64).reshape(-1, 2)
    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (u, v); component is the smallest node of it.

    Each part of at most about EDGES edges is contracted to stars by union-find; where there is one part, that is all.
    Otherwise rounds of alternating stars follow: every neighbour of a node is joined to the smallest one, first the
    larger neighbours, then the smaller, until the table is one star for each component and stays as it is. That takes
    a logarithmic number of rounds, and there is no bound on them. These are aggregates and joins of stored tables, so a node with very many neighbours is split by adaptive
    skew handling.
    """
    now = stored(edges.where("u <> v").select("u", "v"), "edges")
    parts = ceil(now.count() / EDGES)
    now = now.coalesce(1) if parts <= 1 else now.repartition(parts, "u", "v")  # by both, as a hub has too many edges for a task
    now = stored(now.mapInArrow(forest, "u long, v long"), "forest")
    was = None
    while parts > 1:
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == was or not mark["n"]:
            break
        was = mark
        both = now.union(now.select("v", "u"))
        low = stored(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "lowest")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large.where("u <> v"), "large")
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(small.union(low).distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
