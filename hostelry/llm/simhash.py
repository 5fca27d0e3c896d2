"""SimHash near-dedup by multi-index hashing."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import id_key, keep_rows, stored, text_key, whole_text
from .components import FOREST_PAIRS, connected_components, spanning_forest

WORDS = 4
SEED = 42
DISTANCE = 4
BITS = 64
MOST_SEGMENTS = 3
ROW_COST = 8  # a row that is shuffled and sorted costs about as much as comparing this many candidates


def _shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of every shingle of the text, repeats included."""
    # bytes.lower and bytes.split know ASCII only: A-Z, and the six blanks of the contract.
    tokens = text.encode("utf-8").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = list(accumulate(len(t) + 1 for t in tokens))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[words - 1 :])], np.uint64)


def fingerprint_of(text: str, words: int = WORDS) -> int:
    """The signed 64-bit fingerprint: a bit is 1 if it is set in over half the shingle hashes."""
    hashes = _shingle_hashes(text, words)
    set_bits = np.zeros(64, np.int64)
    for part in np.split(hashes, range(65536, len(hashes), 65536)):  # bounded memory for any length
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS) -> DataFrame:
    """doc_id, id_key, text_key and the 64-bit fingerprint ``f`` of every row."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, words) for t in texts], dtype="int64")

    return docs.select(
        F.col(id_column).alias("doc_id"), id_key(id_column).alias("id_key"),
        text_key(text_column).alias("text_key"), simhash(whole_text(text_column)).alias("f"),
    )


def radii(distance: int, segments: int) -> list[int]:
    """Ball radii whose sum plus the number of segments exceeds the distance.

    If every segment differed by more than its radius, the whole would differ by
    at least sum(radius + 1) > distance bits; so a pair within the distance is
    found in some segment.
    """
    spare = max(0, distance + 1 - segments)
    return [spare // segments + (i < spare % segments) for i in range(segments)]


def _ball(width: int, radius: int) -> list[int]:
    """All masks of at most ``radius`` of ``width`` bits."""
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def _balls(width: int, radius: int) -> tuple[list[int], list[int]]:
    """Masks of the probes and of the entries: together they reach ``radius`` bits.

    Two values that differ in r bits meet under a value between them, so each side
    needs half the radius only; for two bits of 32 that is 33 rows a side, not 529 and 1.
    """
    return _ball(width, (radius + 1) // 2), _ball(width, radius // 2)


def segment_widths(segments: int) -> tuple[int, ...]:
    """The bits of a fingerprint dealt evenly over the segments."""
    return tuple(BITS // segments + (i < BITS % segments) for i in range(segments))


def choose_segments(count: int, distance: int = DISTANCE) -> tuple[int, ...]:
    """Widths for ``count`` fingerprints; every choice finds the same links.

    Fewer, wider segments mean larger balls but fewer fingerprints under one value.
    The cost of a fingerprint is its table rows plus the candidates that it meets where values are even.
    At distance 4 three segments are the choice up to about 20 million fingerprints,
    two segments beyond.
    """

    def cost(widths: tuple[int, ...]) -> float:
        balls = [_balls(w, r) for w, r in zip(widths, radii(distance, len(widths)))]
        rows = sum(len(probes) + len(entries) for probes, entries in balls)
        met = sum(len(probes) * len(entries) * count / 2**w for w, (probes, entries) in zip(widths, balls))
        return ROW_COST * rows + met

    return min((segment_widths(k) for k in range(MOST_SEGMENTS, 1, -1)), key=cost)


def _segment(f: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(f, shift).bitwiseAND((1 << width) - 1)


def near_links(nodes: DataFrame, distance: int = DISTANCE, segments: Sequence[int] | None = None) -> DataFrame:
    """Pairs (u, v), u < v, of distinct fingerprints ``f`` that differ in at most ``distance`` bits.

    A segment's values in small Hamming balls around the fingerprint's own are table keys on
    both sides; ``segments`` are the widths, chosen by the number of nodes where not given.
    A pair may be returned several times.
    """
    widths = segments or choose_segments(nodes.count(), distance)
    entries, probes, shift = [], [], 0

    def under(i: int, own: Column, masks: list[int]) -> list[Column]:
        return [F.struct(F.lit(i).alias("s"), own.bitwiseXOR(F.lit(m).cast("long")).alias("key")) for m in masks]

    for i, (width, radius) in enumerate(zip(widths, radii(distance, len(widths)))):
        own = _segment(F.col("f"), shift, width)
        asking, kept = _balls(width, radius)
        probes += under(i, own, asking)
        entries += under(i, own, kept)
        shift += width
    stocked = nodes.select(F.col("f").alias("v"), F.explode(F.array(*entries)).alias("e")).select("v", "e.*")
    asked = nodes.select(F.col("f").alias("u"), F.explode(F.array(*probes)).alias("e")).select("u", "e.*")
    close = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance
    condition = (asked["s"] == stocked["s"]) & (asked["key"] == stocked["key"]) & (F.col("u") < F.col("v")) & close
    return asked.join(stocked, condition).select("u", "v")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    words: int = WORDS, distance: int = DISTANCE, segments: Sequence[int] | None = None,
) -> DataFrame:
    """One row per document row: doc_id, fingerprint (16 hex digits), component_id, text_key.

    Words are runs of non-blank characters after lower-casing A-Z; a text shorter
    than a shingle is one shingle; a text without words (null included) has
    fingerprint zero and links like any other.  Rows with one fingerprint are one
    node, so copies are never paired with each other; links between nodes leave a task
    as a spanning forest, not as pairs.  component_id is the smallest
    doc_id reachable by links; null doc_ids name no component, so a component
    without any id has a null component_id.  An empty table gives no rows.
    """
    prints = stored(fingerprints(docs, id_column, text_column, words), "fingerprints")
    nodes = prints.groupBy("f").agg(F.min("doc_id").alias("least"))
    known = stored(nodes, "nodes")
    links = spanning_forest(near_links(known.select("f"), distance, segments))
    parts = connected_components(stored(links, "links", batch_rows=FOREST_PAIRS), "simhash")
    grouped = known.join(parts, known["f"] == parts["node"], "left").select(
        "f", "least", F.coalesce("component", "f").alias("component")
    )
    least = grouped.groupBy(F.col("component").alias("c")).agg(F.min("least").alias("component_id"))
    labels = grouped.join(least, grouped["component"] == least["c"]).select(F.col("f").alias("node_f"), "component_id")
    return prints.join(labels, prints["f"] == labels["node_f"]).select(
        "doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id", "text_key",
    )


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with the row of smallest doc_id of every component, all columns as they were.

    Rows without a doc_id stay only where their component has no id at all.
    """
    found = near_duplicates(docs, id_column, text_column).where("doc_id <=> component_id")
    first = found.groupBy("fingerprint", "component_id").agg(F.min(F.struct(id_key().alias("id_key"), "text_key")).alias("k"))
    return keep_rows(docs, first.select("k.*"), id_column, text_column)
