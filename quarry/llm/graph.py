"""Connected components of an edge list."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import arrow_map
from .frames import dropped, saved

#: Edges, of 16 bytes, that one task may settle; more are settled in rounds of joins.
FEW = 2_000_000


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest one that the edges (a, b) connect it with."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        np.minimum.at(new, low[a], low[b])
        np.minimum.at(new, low[b], low[a])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    edges = list(batches)
    if not edges:
        return
    u, v = (np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in edges]) for k in (0, 1))
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    low = spanning(len(nodes), at[: len(u)], at[len(u) :])
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[low])], names=["node", "root"])


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for the nodes of ``edges(a, b)``; root is the smallest node reachable.

    Up to ``FEW`` edges are settled by one task.  Beyond it large-star and small-star
    steps alternate until the edges stop changing, which takes O(log^2) rounds.  A round's least neighbours are found by a combining
    aggregation and joined back, so no task gathers the edges of a hub, and adaptive
    execution may split a hub's share of the join.  Each round is written to the
    shared folder, so a lost executor repeats one round at most, and the round before
    is deleted.  Self-loops and nulls are ignored, repeated edges count once, and no
    edges give no rows.
    """
    now = saved(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = _mark(now)
    if before[0] <= FEW:
        return arrow_map(now.coalesce(1), _settle, "node bigint, root bigint")
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = saved(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        after = saved(small.where("u <> v").distinct())
        mark = _mark(after)
        dropped(now, large)
        now = after
        if mark == before:
            break
        before = mark
    pairs = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.unionByName(pairs.select(F.col("root").alias("node"), "root").distinct())
