"""Near-duplicate vectors: random-hyperplane tables, exact cosine, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import stored
from .components import connected_components

COSINE = 0.98
# A pair at cosine 0.98 agrees on one hyperplane with probability 1 - acos(0.98) / pi = 0.936,
# on all 20 of a table with 0.268, and in at least one of 24 tables with 0.9994.
PLANES = 20
TABLES = 24
SEED = 20
CHUNK = 256  # rows of a bucket that are compared in one block

BLOCK = ["label", "dim", "t", "key", "a", "b"]


@lru_cache(maxsize=8)
def _planes(dim: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, count))


def _unit_rows(vectors: list) -> np.ndarray:
    """Rows scaled to length one in double precision; scaling by the largest entry avoids overflow."""
    x = np.asarray(vectors, dtype=np.float64).reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _comparable(embedding: Column) -> Column:
    """Not null or zero, and every component a finite number."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embedding.isNotNull() & finite & F.exists(embedding, lambda x: x != 0)


def _signed(classes: DataFrame, planes: int, tables: int, seed: int) -> DataFrame:
    """c, label, dim, n, embedding and ``keys``: the sign bits of each table as one integer."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = 1 << np.arange(planes, dtype=np.int64)
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                side = _unit_rows(list(part["embedding"])) @ _planes(int(dim), planes * tables, seed) > 0
                keys = side.reshape(len(part), tables, planes) @ weights
                yield part.assign(keys=list(keys))

    schema = "c long, label string, dim int, n long, embedding array<double>, keys array<long>"
    return classes.select("c", "label", "dim", "n", "embedding").mapInPandas(sign, schema)


def _blocks(signed: DataFrame, chunk: int) -> DataFrame:
    """Rows of all buckets with two members or more, dealt into blocks of two chunks.

    A bucket of B rows has ceil(B / chunk) chunks; each row goes to one block for every
    chunk of its bucket, so a block is bounded however large the bucket is.
    """
    at = signed.select("c", "label", "dim", F.posexplode("keys").alias("t", "key"))
    crowded = at.groupBy("label", "dim", "t", "key").agg(F.count("*").alias("size")).where("size > 1")
    chunks = crowded.select(
        F.col("label").alias("l"), F.col("dim").alias("d"), F.col("t").alias("tt"), F.col("key").alias("k"),
        F.ceil(F.col("size") / chunk).cast("int").alias("chunks"),
    )
    same = (at["label"] == chunks["l"]) & (at["dim"] == chunks["d"]) & (at["t"] == chunks["tt"]) & (at["key"] == chunks["k"])
    placed = at.join(chunks, same).select(
        F.col("c").alias("member"), "t", "key", "chunks", F.pmod(F.xxhash64("c"), "chunks").cast("int").alias("chunk")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    dealt = placed.select("member", "t", "key", "chunk", other).select(
        "member", "t", "key", "chunk", F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b")
    )
    return dealt.join(signed, dealt["member"] == signed["c"]).select(*BLOCK, "chunk", "c", "n", "embedding", "keys")


def _links_of_block(rows: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Per row of one block: how many vectors it links with here, and the least row it is joined to.

    A pair counts only in the first table in which it meets, so each link is counted once.
    """
    t, a, b = (int(rows[c].iat[0]) for c in ("t", "a", "b"))
    unit = _unit_rows(list(rows["embedding"]))
    linked = unit @ unit.T >= cosine
    np.fill_diagonal(linked, False)
    if linked.any():
        keys = np.stack(list(rows["keys"]))
        for earlier in range(t):
            linked &= keys[:, None, earlier] != keys[None, :, earlier]
        if a != b:
            chunk = rows["chunk"].to_numpy()
            linked &= chunk[:, None] != chunk[None, :]
    c = rows["c"].to_numpy()
    root = c.copy()
    while True:
        lowest = np.minimum(root, np.where(linked, root[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (lowest == root).all():
            break
        root = lowest
    found = linked.any(axis=1)
    return pd.DataFrame({"c": c, "links": linked @ rows["n"].to_numpy(), "root": root})[found]


def _links(blocks: DataFrame, cosine: float) -> DataFrame:
    """c, links, root from every block; a task works through its sorted blocks one by one."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            starts = np.flatnonzero((rows[BLOCK] != rows[BLOCK].shift()).any(axis=1).to_numpy())
            for start, end in zip(starts, starts[1:]):
                yield _links_of_block(rows.iloc[start:end], cosine)
            rest = rows.iloc[starts[-1] :] if len(starts) else rest
        if rest is not None and len(rest):
            yield _links_of_block(rest, cosine)

    return blocks.repartition(*BLOCK).sortWithinPartitions(*BLOCK).mapInPandas(compare, "c long, links long, root long")


def embedding_duplicates(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    cosine: float = COSINE, planes: int = PLANES, tables: int = TABLES, seed: int = SEED, chunk: int = CHUNK,
) -> DataFrame:
    """One row per vector row: vec_id, n_links, component_id, kept.

    Only vectors with equal, non-null labels and equal lengths are compared.  Equal
    vectors of one label form a class first, so copies are never paired; candidate
    classes share a bucket of a hyperplane table and are linked when their exact
    cosine reaches ``cosine``.  n_links counts the other rows linked directly, copies
    included.  component_id is the smallest vec_id reachable.  Vectors that are
    null, empty, zero, or hold null or non-finite parts, rows without a label and
    rows without an id link with nothing: n_links 0, component_id their own id, kept.
    Other columns are not read; an empty table gives no rows.
    """
    rows = vectors.select(
        F.col(id_column).alias("vec_id"), F.col(label_column).cast("string").alias("label"),
        F.col(vector_column).cast("array<double>").alias("embedding"),
    )
    usable = _comparable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    fit = rows.where(F.coalesce(usable, F.lit(False)))
    unfit = rows.where(~F.coalesce(usable, F.lit(False)))
    classes = stored(
        fit.groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
        .withColumns({"dim": F.size("embedding"), "c": F.monotonically_increasing_id()}),
        "classes",
    )
    links = stored(_links(_blocks(stored(_signed(classes, planes, tables, seed), "signed"), chunk), cosine), "links")
    counted = links.groupBy(F.col("c").alias("linked")).agg(F.sum("links").alias("links"))
    parts = connected_components(links.select(F.col("c").alias("u"), F.col("root").alias("v")), "vectors")
    found = classes.join(counted, classes["c"] == counted["linked"], "left").join(
        parts, classes["c"] == parts["node"], "left"
    ).select(
        "label", "embedding", "least", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "c").alias("component"),
    )
    found = stored(found, "found")
    least = found.groupBy(F.col("component").alias("part")).agg(F.min("least").alias("component_id"))
    labelled = found.join(least, found["component"] == least["part"]).select(
        F.col("label").alias("l"), F.col("embedding").alias("e"), "n_links", "component_id"
    )
    linked = fit.join(labelled, (fit["label"] == labelled["l"]) & (fit["embedding"] == labelled["e"])).select(
        "vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")
    )
    alone = unfit.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    return linked.union(alone)
