"""Packing documents into fixed windows by non-negative least squares over length patterns.

A document's tokens are cut into whole windows from its start and one remainder.
Remainders are counted by length.  Lengths are rounded up to a grid; every pattern of
up to three grid lengths that fills the window is a column, and non-negative least
squares finds how often to use each so that the patterns use up the histogram.  The
counts are rounded down; pieces beyond them are packed greedily, each window filled
to the brim by cutting the piece that crosses its end.  Only the histogram, of at
most a window of numbers, reaches the driver.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import stored, whole_text
from .vocabulary import OTHER_CODE_POINTS, PATTERN, vocabulary

WINDOW = 2048
END_TOKEN = 1
GRID = 8
PARTS = 3
FILE_ROWS = 50_000  # rows of one file of the tables of places, at least about
PIECE_BATCH = 200  # texts of one Arrow batch while ids are written
LONG_WORD = 2000  # texts with longer words or blank runs are left to the tokenizer library
_LONG = regex.compile(r"\S{%d}|\s{%d}" % (LONG_WORD, LONG_WORD))


class Encoder:
    """Token ids of texts, equal to those of the tokenizer library.

    The fast merger takes ids as ranks, which holds for vocabularies that number their
    tokens in the order of the merges; others, texts with code points on which Unicode
    versions differ, and very long words go to the library.
    """

    def __init__(self, path: str):
        vocab = vocabulary(path)
        self.vocab = vocab
        ordered = np.array_equal(np.sort(vocab.made_by), vocab.made_by) and vocab.made_by.min() > vocab.byte_ids.max()
        self.fast = tiktoken.Encoding(
            "vocabulary", pat_str=PATTERN, mergeable_ranks=vocab.id_of, special_tokens=vocab.special
        ) if ordered else None

    def encode(self, text: str) -> np.ndarray:
        if self.fast is None or OTHER_CODE_POINTS.search(text) or _LONG.search(text):
            return np.array(self.vocab.library.encode(text, add_special_tokens=False).ids, "<u4")
        return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per process."""
    return Encoder(path)


def _pieces(docs: DataFrame, path: str, id_column: str, text_column: str, window: int, end_token: int, with_ids: bool) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens and ids of each piece, and ``row``, a number of its own.

    ``part`` is the task that made the piece and ``nth`` counts the pieces of its length before it there.
    Only a remainder may be cut later, so whole windows have ids on demand alone.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[int] = Counter()
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                ids = np.append(encoder(path).encode(row.text), np.uint32(end_token)).astype("<u4")
                for start in range(0, len(ids), window):
                    data = ids[start : start + window].tobytes()
                    length = len(data) // 4
                    rows.append((row.doc_id, start, length, zlib.crc32(data), len(ids), seen[length], data if with_ids or length < window else None))
                    seen[length] += 1
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "nth", "ids"])

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, nth long, ids binary"
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
    made = source.mapInPandas(cut, schema).withColumns({"row": F.monotonically_increasing_id(), "part": F.spark_partition_id()})
    return stored(made, "pieces", batch_rows=PIECE_BATCH)


def patterns(units: int, parts: int) -> list[tuple[int, ...]]:
    """All ascending tuples of up to ``parts`` whole numbers that sum to ``units``."""
    if parts == 1:
        return [(units,)]
    found = [(units,)]
    for count in range(2, parts + 1):
        found += [p for p in _sums(units, count, 1)]
    return found


def _sums(total: int, count: int, least: int) -> Iterator[tuple[int, ...]]:
    if count == 1:
        yield (total,)
        return
    for first in range(least, total // count + 1):
        for rest in _sums(total - first, count - 1, first):
            yield (first, *rest)


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by the active-set method.

    Columns enter by the steepest gradient; when a solution on the columns in use turns
    negative somewhere, the step stops at the border and that column leaves.  The
    result uses no more columns than there are rows.
    """
    x, used = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    tolerance = 1e-9 * max(1.0, np.abs(a.T @ b).max(initial=0))
    for _ in range(3 * a.shape[0]):
        slope = a.T @ (b - a @ x)
        slope[used] = -np.inf
        best = int(slope.argmax())
        if slope[best] <= tolerance:
            break
        used[best] = True
        while True:
            at = np.flatnonzero(used)
            part = a[:, at]
            solution = np.linalg.solve(part.T @ part + 1e-9 * np.eye(len(at)), part.T @ b)
            if (solution > 0).all():
                break
            ratio = np.where(solution <= 0, x[at] / np.maximum(x[at] - solution, 1e-300), np.inf)
            x[at] += min(1.0, ratio.min()) * (solution - x[at])
            leaving = at[ratio == ratio.min()]
            x[leaving], used[leaving] = 0.0, False
        x[:] = 0
        x[at] = solution
    return x


@dataclass
class Plan:
    """Where the q-th piece of each length goes.

    Pieces of patterns are in intervals of q, sorted by (length, first).  The others
    form one stream, lengths ascending; windows are cut from it.
    """

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray  # of the interval's first piece; the next pieces have the next ones
    place: np.ndarray  # order within the sequence
    patterned: np.ndarray  # by length: how many pieces are in patterns
    stream: np.ndarray  # by length: where in the stream its other pieces start
    sequences: int  # in patterns; those of the stream come after

    def find(self, length: np.ndarray, q: np.ndarray) -> pd.DataFrame:
        """sequence_id and place of pieces of patterns, ``at`` in the stream of the others (else -1)."""
        keys = self.length * (1 << 40) + self.first
        at = np.maximum(0, np.searchsorted(keys, length * (1 << 40) + q, "right") - 1)
        fits = q < self.patterned[length]
        sequence = self.sequence[at] + q - self.first[at] if len(keys) else np.zeros(len(q), np.int64)
        place = self.place[at] if len(keys) else np.zeros(len(q), np.int64)
        stream = self.stream[length] + (q - self.patterned[length]) * length
        return pd.DataFrame({"sequence_id": sequence, "place": place, "at": np.where(fits, -1, stream)})


def plan_windows(histogram: dict[int, int], window: int = WINDOW, grid: int = GRID, parts: int = PARTS) -> Plan:
    """A place for every piece counted in the histogram of lengths (1 to window - 1)."""
    units = window // grid
    by_unit: dict[int, list[int]] = {}
    for length in sorted(histogram):
        by_unit.setdefault(-(-length // grid), []).append(length)
    supply = np.zeros(units)
    for unit, lengths in by_unit.items():
        supply[unit - 1] = sum(histogram[x] for x in lengths)
    columns = [p for p in patterns(units, parts) if all(supply[u - 1] for u in p)]
    matrix = np.zeros((units, len(columns)))
    for c, pattern in enumerate(columns):
        for unit in pattern:
            matrix[unit - 1, c] += 1
    repeats = np.floor(nonnegative_least_squares(matrix, supply) + 1e-6).astype(np.int64) if columns else []
    intervals: list[tuple[int, int, int, int]] = []
    left = Counter(histogram)
    sequences = 0
    for pattern, wanted in zip(columns, repeats):
        # The solution may use up a little more of a length than there is.
        count = min([int(wanted), *(sum(left[x] for x in by_unit[u]) // k for u, k in Counter(pattern).items())])
        for place, unit in enumerate(pattern):
            done = 0
            for length in by_unit[unit]:
                part = min(left[length], count - done)
                if part:
                    intervals.append((length, histogram[length] - left[length], sequences + done, place))
                    left[length] -= part
                    done += part
        sequences += count
    table = np.array(sorted(intervals), np.int64).reshape(-1, 4)
    counts = np.array([[histogram.get(x, 0), left[x]] for x in range(window)], np.int64)
    stream = np.r_[0, np.cumsum(counts[:, 1] * np.arange(window))[:-1]]
    return Plan(table[:, 0], table[:, 1], table[:, 2], table[:, 3], counts[:, 0] - counts[:, 1], stream, sequences)


def _files(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of about ``rows`` rows at most, in no more partitions than they are worth."""
    return df.coalesce(1 + rows // FILE_ROWS)


def _ranked(rows: DataFrame, total: int) -> DataFrame:
    """``rows``, ``total`` of them, with q, the rank of each among the rows of its length.

    The task that made a row has counted those of its length before it; to that comes what
    earlier tasks made.  No row is sorted, and the window has one row per task and length.
    """
    sizes = rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("length").alias("l"), F.col("part").alias("p"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    offsets = stored(_files(offsets, total), "offsets")
    # One row per task and length: as a file it is small, but in memory too much to send to every executor.
    offsets = offsets.hint("merge")
    joined = rows.join(offsets, (rows["length"] == offsets["l"]) & (rows["part"] == offsets["p"]))
    return joined.withColumn("q", F.col("base") + F.col("nth")).drop("l", "p", "base")


def pack_documents(
    docs: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text_column: str = "text",
    window: int = WINDOW, end_token: int = END_TOKEN, grid: int = GRID, parts: int = PARTS, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset [, ids].

    A document row is its token ids, as the tokenizer library gives them without added
    tokens, and ``end_token``; null and empty texts are that token alone.  Each id is in
    exactly one piece, and the pieces of a sequence follow each other from offset 0,
    ``window`` ids at most.  Whole windows are sequences of their own.  ids, the piece's
    ids as little-endian unsigned 32-bit integers, come on demand.  Rows with one doc_id
    are packed each; other columns are not read; an empty table gives no rows.
    """
    pieces = _pieces(docs, vocabulary_path, id_column, text_column, window, end_token, with_ids)
    digests = pieces.drop("ids")
    remainders = digests.where(F.col("length") < window)
    histogram = {r["length"]: r["count"] for r in remainders.groupBy("length").count().collect()}
    plan = plan_windows(histogram, window, grid, parts)
    streamed = sum(x * (n - int(plan.patterned[x])) for x, n in histogram.items())
    sequences = plan.sequences + -(-streamed // window)

    @F.pandas_udf("sequence_id long, place long, at long")
    def slot(length: pd.Series, q: pd.Series) -> pd.DataFrame:
        return plan.find(length.to_numpy(np.int64), q.to_numpy(np.int64))

    total = sum(histogram.values())
    zero = F.lit(0).cast("long")
    at, in_stream = F.col("slot.at"), F.col("slot.at") >= 0
    # Of a piece of the stream that crosses the end of a window, ``head`` ids are before it.
    head = F.when(in_stream, F.least("length", window - at % window)).otherwise(F.col("length"))
    sequence = F.when(in_stream, F.floor(at / window) + plan.sequences).otherwise(F.col("slot.sequence_id"))
    place = F.when(in_stream, at % window).otherwise(F.col("slot.place"))

    def half(skip: Column, length: Column, sequence_id: Column, place: Column) -> Column:
        return F.struct(skip.alias("skip"), length.alias("length"), sequence_id.cast("long").alias("sequence_id"), place.cast("long").alias("place"))

    halves = _ranked(remainders, total).withColumn("slot", slot("length", "q")).withColumn("head", head).select(
        "doc_id", "start", "ids_crc32", "doc_tokens", "row", (F.col("head") < F.col("length")).alias("cut"),
        F.inline(F.array(half(zero, F.col("head"), sequence, place), half(F.col("head"), F.col("length") - F.col("head"), sequence + 1, zero))),
    ).where("length > 0")
    # A sequence has at most a window of pieces; those of the stream follow each other too.
    ahead = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "row", "skip"]
    placed = halves.withColumns({"offset": F.coalesce(F.sum("length").over(ahead), zero), "start": F.col("start") + F.col("skip")})
    placed = stored(_files(placed.select(*names, "cut"), total), "placed")
    full = digests.where(F.col("length") == window).withColumns({
        "sequence_id": F.col("row") + sequences, "offset": zero, "skip": zero,
    })
    whole = placed.where("not cut").select(*names).unionByName(full.select(*names))
    bytes_of = pieces.select(F.col("row").alias("piece"), "ids")
    part = F.substring(F.col("ids"), (F.col("skip") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int"))
    cut = stored(_files(placed.where("cut").select(*names), 2 * -(-streamed // window)), "cut")
    cut = cut.join(bytes_of, cut["row"] == bytes_of["piece"]).withColumn("ids_crc32", F.crc32(part)).drop("piece", "ids")
    result = whole.unionByName(cut)
    if with_ids:
        result = result.join(bytes_of, result["row"] == bytes_of["piece"]).withColumn("ids", part).drop("piece")
    return result.drop("row", "skip")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and the ids of each sequence, from pieces packed ``with_ids``."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate("pieces", F.lit(b""), lambda done, piece: F.concat(done, piece["ids"]))
    return packed.groupBy("sequence_id").agg(ordered.alias("pieces")).select("sequence_id", joined.alias("ids"))
