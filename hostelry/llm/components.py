"""Connected components by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import stored

# Pairs a task gathers before it reduces them, and nodes it holds before it hands them on.
FOREST_PAIRS, FOREST_NODES = 1 << 17, 1 << 20


def _stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of every node that is not the least of its component."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    root = np.arange(len(nodes))
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
        while (root[root] != root).any():
            root = root[root]
    child = root != np.arange(len(nodes))
    return nodes[child], nodes[root[child]]


def spanning_forest(edges: DataFrame, pairs: int = FOREST_PAIRS, nodes: int = FOREST_NODES) -> DataFrame:
    """Edges (u, v) with the components of ``edges``, fewer per task than the task has nodes.

    A group in which every pair is linked has quadratically many edges; each task
    reduces its own to one edge per node as they come, so the pairs are neither
    written nor shuffled.  A task holds ``pairs`` new edges and ``nodes`` reduced ones
    (and as many new ones as reduced, so that the work stays linear); with more, it
    hands the reduced ones on and begins anew.  Loops give nothing, and so do null
    ends; no edges give no rows.
    """

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        reduced = waiting = 0
        for batch in batches:
            held.append((batch["u"].to_numpy(np.int64), batch["v"].to_numpy(np.int64)))
            waiting += len(batch)
            if waiting < max(pairs, reduced):
                continue
            u, v = _stars(*(np.concatenate(side) for side in zip(*held)))
            held, reduced, waiting = [(u, v)], len(u), 0
            if reduced >= nodes:
                yield pd.DataFrame({"u": u, "v": v})
                held, reduced = [], 0
        if held:
            u, v = _stars(*(np.concatenate(side) for side in zip(*held)))
            yield pd.DataFrame({"u": u, "v": v})

    whole = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u <> v")
    return whole.mapInPandas(reduce, "u long, v long")


def _with_least_neighbour(edges: DataFrame, name: str) -> DataFrame:
    """Edges (u, v) with the least of u and all its neighbours as ``m``.

    The least neighbour is a partial aggregate.  It is written first, so that the join
    back is one of two shuffled tables, whose large partitions adaptive execution
    splits: a node with very many neighbours is no single task's work.
    """
    least = stored(edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("lowest")), name)
    joined = edges.join(least, edges["u"] == least["w"])
    return joined.select("u", "v", F.least("u", "lowest").alias("m"))


def _large_star(edges: DataFrame, name: str) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = _with_least_neighbour(both, name).where("v > u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame, name: str) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = _with_least_neighbour(down, name)
    moved = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(linked.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, name: str = "edges") -> DataFrame:
    """(node, component) for each node that has an edge; component is the least node reachable.

    ``edges`` has two long columns u and v; loops, repeats, either direction and
    null ends (ignored) are allowed; no edges give no rows.  Each round is written to the shared folder.  It
    ends when both stars leave the edges as they are: then every edge is
    (node, least node).  The number of rounds grows with the logarithm of the
    longest path.
    """
    clean = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current = stored(clean.distinct(), f"{name}-0")
    step = 0
    mark = _mark(current)
    while mark[0]:
        step += 1
        current = stored(_large_star(current, f"{name}-{step}-up"), f"{name}-{step}-large")
        current = stored(_small_star(current, f"{name}-{step}-down"), f"{name}-{step}")
        before, mark = mark, _mark(current)
        if mark == before and _is_flat(current):
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select("v", "v").distinct().toDF("node", "component")
    )


def _mark(edges: DataFrame) -> tuple:
    """One row that tells two rounds apart: count and order-free sum of hashes."""
    hashed = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), hashed).first())


def _is_flat(edges: DataFrame) -> bool:
    """No node is both a child and a parent, and no child has two parents."""
    parents = edges.select(F.col("v").alias("u")).distinct()
    children = edges.groupBy("u").count()
    return (
        children.where("count > 1").isEmpty()
        and edges.join(parents, "u", "left_semi").isEmpty()
    )
