"""Connected components: at once where the edges fit a task, else by alternating stars.

Up to LOCAL edges (counted first; 16 bytes each) are labelled by one task. Beyond that,
large-star and small-star steps alternate; both ways name a component by its smallest
node. Each step is a grouped minimum and a join; a node with very many edges is joined
through join_hot. The edges of every round are written to the shared folder, so a lost
executor costs one round at most. Only two numbers a round come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT_ROWS, Stored, bounded, join_hot

#: Edges that one task labels at most.
LOCAL = 1_000_000

#: Rounds are logarithmic in the longest path; this many means that something is wrong.
ROUNDS = 60


def _star(edges: DataFrame, least: DataFrame) -> DataFrame:
    """edges (u, v) joined with least (u, m, d)."""
    top = least.agg(F.max("d")).first()[0]
    if top is not None and top >= HOT_ROWS:
        return join_hot(edges, least, "u", "d", "inner")
    return edges.join(least, "u")


def label(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, components) of edges: least labels spread along edges and are followed to their own labels."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    own = np.arange(len(nodes))
    while True:
        low = np.minimum(own[x], own[y])
        new = own.copy()
        np.minimum.at(new, own[x], low)
        np.minimum.at(new, own[y], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == own).all():
            return nodes, nodes[own]
        own = new


def _label_here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(np.asarray(b.column(0)), np.asarray(b.column(1))) for b in batches]
    if held:
        nodes, of = label(*[np.concatenate(x) for x in zip(*held, strict=True)])
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(of)], names=["node", "component"])


def connected_components(edges: DataFrame, local: int = LOCAL) -> DataFrame:
    """(node, component) of every node in edges (a, b); component is its smallest node."""
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    held, mark = Stored(pairs, "edges"), None
    if bounded(held.df, local):
        return held.df.repartition(1).mapInArrow(_label_here, "node long, component long")
    for _ in range(ROUNDS):
        both = held.df.unionByName(held.df.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("d"))
        # large star: neighbours above u go to u's smallest neighbour
        large = Stored(_star(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        # small star: u and its neighbours, all below it, go to the smallest of them
        low = large.df.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("d"))
        moved = _star(large.df, low).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = Stored(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        large.drop()
        held.drop()
        held = after
        now = tuple(held.df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    stars = held.df.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = stars.select(F.col("component").alias("node"), "component").distinct()
    return stars.unionByName(roots)
