"""Reversible line dedup: exact reference counts with sharded cuckoo filters in front."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import id_key, stored, text_key, whole_text
from .cuckoo import CuckooFilter

MIN_CHARS = 40
MIN_DOCS = 5
SHARD_KEYS = 1024  # repeated keys of one shard, about
GROUP_LINES = 10_000  # lines that meet one copy of a shard's filter, about

BLANKS = " \t\n\x0b\x0c\r"
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

FILTER_SCHEMA = "shard long, buckets int, marks binary"


def line_key(line: str) -> str:
    """Blanks stripped at both ends, A-Z lower-cased."""
    return line.strip(BLANKS).translate(_LOWER)


def _digest(key: str) -> tuple[int, int]:
    """128 bits that stand for a key, as two signed integers."""
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(key.encode("utf-8")), "<i8").tolist())


def _digests(text: str, min_chars: int) -> list[tuple[int, int] | None]:
    """Per line the digest of its key, or None where the key is too short to count."""
    keys = map(line_key, text.split("\n"))
    return [_digest(k) if len(k) >= min_chars else None for k in keys]


@dataclass(frozen=True)
class LineIndex:
    """What is known of the lines of all documents inserted and not deleted.

    references: h1, h2, doc_id, id_key, refs - how many rows with that doc_id hold the key
    counts: h1, h2, docs, holder - rows that hold the key, and the largest doc_id of them
    filters: shard, buckets, marks - a cuckoo filter per shard over keys held by ``min_docs`` rows
    """

    references: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    min_chars: int
    min_docs: int


def _postings(docs: DataFrame, id_column: str, text_column: str, min_chars: int) -> DataFrame:
    """h1, h2, doc_id, id_key, text_key: the distinct keys of every document row."""
    source = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), id_key(id_column).alias("id_key"),
        text_key(text_column).alias("text_key"), whole_text(text_column).alias("text"),
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [np.array(sorted(set(_digests(t, min_chars)) - {None}), np.int64).reshape(-1, 2) for t in batch.text]
            sizes = [len(x) for x in found]
            rows = np.repeat(np.arange(len(batch)), sizes)
            keys = np.concatenate([*found, np.empty((0, 2), np.int64)])
            yield pd.DataFrame({"h1": keys[:, 0], "h2": keys[:, 1]} | {
                c: batch[c].take(rows).array for c in ("doc_id", "id_key", "text_key")
            })

    return source.mapInPandas(cut, "h1 long, h2 long, doc_id long, id_key long, text_key long")


def _references(postings: DataFrame) -> DataFrame:
    return postings.groupBy("h1", "h2", "doc_id", "id_key").agg(F.count("*").alias("refs"))


def _counts(references: DataFrame) -> DataFrame:
    """Held per key; the partial sums keep a line of very many documents small."""
    return references.groupBy("h1", "h2").agg(F.sum("refs").alias("docs"), F.max("doc_id").alias("holder"))


def _shard(shards: int):
    return F.pmod(F.col("h2"), F.lit(shards)).alias("shard")


def _change_filters(filters: DataFrame, changes: DataFrame, counts: DataFrame, shards: int, min_docs: int) -> DataFrame:
    """Filters after ``changes`` (h1, h2, added): keys that became repeated or ceased to be.

    A shard whose filter is full is built anew, twice as large, from the exact counts.
    """
    repeated = counts.where(F.col("docs") >= min_docs).select("h1", "h2")
    told = changes.select("h1", "h2", F.col("added").cast("int").alias("change")).union(
        repeated.select("h1", "h2", F.lit(0).alias("change"))
    ).select(_shard(shards), "h1", "change")

    def change(old: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        present = rows.h1[rows.change == 0].to_numpy()
        added, removed = rows.h1[rows.change == 1].to_numpy(), rows.h1[rows.change == -1].to_numpy()
        shard = int((rows if len(rows) else old).shard.iat[0])
        buckets = CuckooFilter.room_for(len(present))
        try:
            if not len(old):
                raise CuckooFilter.Full
            buckets = int(old.buckets.iat[0])
            held = CuckooFilter(buckets, old.marks.iat[0])
            held.delete(removed)
            held.insert(added)
        except CuckooFilter.Full:
            while True:
                try:
                    held = CuckooFilter(buckets)
                    held.insert(present)
                    break
                except CuckooFilter.Full:
                    buckets *= 2
        return pd.DataFrame({"shard": [shard], "buckets": [buckets], "marks": [held.tobytes()]})

    return filters.groupBy("shard").cogroup(told.groupBy("shard")).applyInPandas(change, FILTER_SCHEMA)


def build_index(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, shard_keys: int = SHARD_KEYS,
) -> LineIndex:
    """The index of a set of documents; later sets go in with ``insert_documents``."""
    return _index_of(_postings(docs, id_column, text_column, min_chars), min_chars, min_docs, shard_keys)


def _index_of(postings: DataFrame, min_chars: int, min_docs: int, shard_keys: int) -> LineIndex:
    references = stored(_references(postings), "references")
    counts = stored(_counts(references), "counts")
    repeated = counts.where(F.col("docs") >= min_docs)
    shards = repeated.count() // shard_keys + 1
    empty = counts.sparkSession.createDataFrame([], FILTER_SCHEMA)
    added = repeated.select("h1", "h2", F.lit(1).alias("added"))
    filters = stored(_change_filters(empty, added, counts, shards, min_docs), "filters")
    return LineIndex(references, counts, filters, shards, min_chars, min_docs)


def _changed(index: LineIndex, delta: DataFrame, sign: int) -> LineIndex:
    """The index with the references of ``delta`` added or taken away."""
    signed = delta.withColumn("refs", F.col("refs") * sign)
    merged = index.references.union(signed.select(*index.references.columns))
    references = stored(
        merged.groupBy("h1", "h2", "doc_id", "id_key").agg(F.sum("refs").alias("refs")).where("refs > 0"), "references"
    )
    counts = stored(_counts(references), "counts")
    enough = F.coalesce(F.col("docs"), F.lit(0)) >= index.min_docs
    before = index.counts.where(enough).select("h1", "h2")
    after = counts.where(enough).select("h1", "h2")
    changes = after.join(before, ["h1", "h2"], "left_anti").withColumn("added", F.lit(1)).union(
        before.join(after, ["h1", "h2"], "left_anti").withColumn("added", F.lit(-1))
    )
    filters = stored(_change_filters(index.filters, changes, counts, index.shards, index.min_docs), "filters")
    return replace(index, references=references, counts=counts, filters=filters)


def insert_documents(index: LineIndex, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> LineIndex:
    """The index after adding document rows."""
    return _changed(index, _references(_postings(docs, id_column, text_column, index.min_chars)), 1)


def delete_documents(index: LineIndex, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> LineIndex:
    """The index after removing document rows that were inserted before, given with their texts."""
    return _changed(index, _references(_postings(docs, id_column, text_column, index.min_chars)), -1)


def _possibly_repeated(index: LineIndex, postings: DataFrame, group_lines: int) -> DataFrame:
    """The postings whose key the shard's filter might hold.

    A shard with many lines, such as that of a line in a third of all documents, is
    dealt over several copies of its filter, so each group stays bounded.
    """
    placed = postings.withColumn("shard", F.pmod(F.col("h2"), F.lit(index.shards)))
    # One row per shard, written first so that Spark knows its size: while it is small, no line
    # is shuffled to look its shard up.
    copies = stored(placed.groupBy("shard").agg((F.floor(F.count("*") / group_lines) + 1).alias("copies")), "copies")
    filters = index.filters.join(copies, "shard").select(
        "shard", "buckets", "marks", "copies", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy")
    )
    dealt = placed.join(copies, "shard").withColumn("copy", F.pmod(F.xxhash64("id_key", "text_key"), "copies")).drop("copies")

    def look_up(held: pd.DataFrame, lines: pd.DataFrame) -> pd.DataFrame:
        lines = lines[["h1", "h2", "doc_id", "id_key", "text_key"]]
        if not len(held) or not len(lines):
            return lines.head(0)
        return lines[CuckooFilter(int(held.buckets.iat[0]), held.marks.iat[0]).might_hold(lines.h1.to_numpy())]

    return (
        filters.groupBy("shard", "copy").cogroup(dealt.groupBy("shard", "copy"))
        .applyInPandas(look_up, "h1 long, h2 long, doc_id long, id_key long, text_key long")
    )


def clean_lines(
    index: LineIndex, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    postings: DataFrame | None = None, group_lines: int = GROUP_LINES,
) -> DataFrame:
    """One row per document row: doc_id, n_lines, n_dropped, kept_sha256, kept_text.

    Texts are split at \\n (null and empty: one empty line).  A line whose key has
    ``min_chars`` code points or more and is held by ``min_docs`` document rows or
    more is dropped, except from rows with the largest doc_id holding it; a null
    doc_id counts as the smallest.  The filters tell which lines may be repeated;
    the exact counts decide.  Repeated lines inside one document count once.  An
    empty table gives no rows; other columns of ``docs`` are not read.
    """
    min_chars = index.min_chars
    if postings is None:
        postings = _postings(docs, id_column, text_column, min_chars)
    repeated = index.counts.where(F.col("docs") >= index.min_docs).select(
        F.col("h1").alias("r1"), F.col("h2").alias("r2"), "holder"
    )
    asked = _possibly_repeated(index, postings, group_lines)
    surplus = asked.join(repeated, (asked["h1"] == repeated["r1"]) & (asked["h2"] == repeated["r2"])).where(
        ~F.col("doc_id").eqNullSafe(F.col("holder"))
    )
    drops = surplus.groupBy("id_key", "text_key").agg(F.collect_set(F.struct("h1", "h2")).alias("drops")).select(
        F.col("id_key").alias("i"), F.col("text_key").alias("k"), F.col("drops.h1").alias("d1"), F.col("drops.h2").alias("d2")
    )
    source = docs.select(
        F.col(id_column).alias("doc_id"), id_key(id_column).alias("id_key"),
        text_key(text_column).alias("text_key"), whole_text(text_column).alias("text"),
    )
    joined = source.join(drops, (source["id_key"] == drops["i"]) & (source["text_key"] == drops["k"]), "left")

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, d1, d2 in zip(batch.text, batch.d1, batch.d2):
                lines = text.split("\n")
                gone = set() if d1 is None else set(zip(d1.tolist(), d2.tolist()))
                kept = [x for x, d in zip(lines, _digests(text, min_chars)) if d not in gone] if gone else lines
                left = "\n".join(kept)
                out.append((len(lines), len(lines) - len(kept), hashlib.sha256(left.encode("utf-8")).hexdigest(), left))
            made = pd.DataFrame(out, columns=["n_lines", "n_dropped", "kept_sha256", "kept_text"])
            yield pd.concat([batch[["doc_id"]].reset_index(drop=True), made], axis=1)

    return joined.select("doc_id", "text", "d1", "d2").mapInPandas(
        keep, "doc_id long, n_lines long, n_dropped long, kept_sha256 string, kept_text string"
    )


def line_dedup(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
) -> DataFrame:
    """``clean_lines`` of a set of documents against its own index; the lines are cut once."""
    postings = stored(_postings(docs, id_column, text_column, min_chars), "postings")
    index = _index_of(postings, min_chars, min_docs, SHARD_KEYS)
    return clean_lines(index, docs, id_column, text_column, postings)
