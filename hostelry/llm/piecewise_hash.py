"""Document fingerprints by context-triggered piecewise hashing.

A hash rolls over the last 8 code points; where it hits a residue of the block size a
chunk ends, so an edit moves only the boundaries near it.  Each chunk gives one symbol
of 12 bits, written as two letters.  The block size follows from the text's length, and
a fingerprint holds the signatures for that size and its double, so texts whose lengths
differ up to about twofold have a size in common.  Likeness is one minus the edit distance of
two signatures of one block size over their joint length (insertions and deletions
cost one, so an exchanged symbol costs two).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import stored, text_key, whole_text

SYMBOLS = 64  # symbols of a signature, at most, on average
LEAST_BLOCK = 3
REACH = 8  # code points the rolling hash sees
MAX_REPEAT = 3  # equal symbols in a row that a signature keeps
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_STRIDE = 1 << 20  # code points hashed at once
_PAIRS = [a + b for a in LETTERS for b in LETTERS]


def block_size(n_chars: int) -> int:
    """The least 3 * 2^k with which the text has at most SYMBOLS chunks on average."""
    size = LEAST_BLOCK
    while size * SYMBOLS < n_chars:
        size *= 2
    return size


def _boundaries(points: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the chunks of block size ``size``, and which of them also end one of the double size."""
    ends, double = [], []
    for begin in range(0, len(points), _STRIDE):
        low = max(0, begin - REACH + 1)
        part = points[low : begin + _STRIDE].astype(np.uint64)
        with np.errstate(over="ignore"):
            part = (part + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            step, factor = 1, np.uint64(0xD1342543DE82EF95)
            while step < REACH:  # sums over 2, 4, 8 code points; fewer at the start of the text
                part[step:] += part[:-step] * factor
                factor *= factor
                step *= 2
            mixed = (part ^ (part >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        high = (mixed >> np.uint64(32)).astype(np.uint32)[begin - low :]
        hit = np.flatnonzero(high % np.uint32(size) == size - 1)
        ends.append(begin + hit + 1)
        double.append(high[hit] % np.uint32(2 * size) == 2 * size - 1)
    return (np.concatenate(ends), np.concatenate(double)) if ends else (np.empty(0, np.int64), np.empty(0, bool))


def _signature(data: bytes, ends: np.ndarray) -> list[int]:
    """A symbol per chunk, the one after the last boundary included; long rows of one symbol are cut."""
    total = len(data) // 4
    ends = ends.tolist()
    if total and (not ends or ends[-1] != total):
        ends.append(total)
    out, begin = [], 0
    for end in ends:
        symbol = xxhash.xxh3_64_intdigest(data[4 * begin : 4 * end]) & 4095
        begin = end
        if out[-MAX_REPEAT:] != [symbol] * MAX_REPEAT:
            out.append(symbol)
    return out


Fingerprint = tuple[int, list[int], list[int]]  # block size, its symbols, those of the double size


def fingerprint(text: str) -> Fingerprint:
    data = text.encode("utf-32-le", "surrogatepass")
    size = block_size(len(text))
    ends, double = _boundaries(np.frombuffer(data, "<u4"), size)
    return size, _signature(data, ends), _signature(data, ends[double])


def written(value: Fingerprint) -> str:
    """``size:symbols:symbols``, two letters a symbol."""
    return f"{value[0]}:{''.join(map(_PAIRS.__getitem__, value[1]))}:{''.join(map(_PAIRS.__getitem__, value[2]))}"


def _read(text: str) -> Fingerprint:
    size, *parts = text.split(":")
    at = {c: i for i, c in enumerate(LETTERS)}
    one, two = ([at[a] * 64 + at[b] for a, b in zip(p[::2], p[1::2])] for p in parts)
    return int(size), one, two


def edit_distance(a: list[int], b: list[int]) -> int:
    """Insertions and deletions that turn a into b: the rows of the table are the bits of one integer."""
    places: dict[int, int] = {}
    for i, symbol in enumerate(a):
        places[symbol] = places.get(symbol, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    for symbol in b:
        common = row & places.get(symbol, 0)
        row = (row + common | row - common) & full
    return len(a) + len(b) - 2 * (len(a) - row.bit_count())


def _likeness_of(a: list[int], b: list[int]) -> float:
    return 1.0 if a == b else 1.0 - edit_distance(a, b) / (len(a) + len(b))


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """0 to 1: the greater one over the block sizes both have; 0 without one; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    if a[0] == b[0]:
        return max(_likeness_of(a[1], b[1]), _likeness_of(a[2], b[2]))
    if a[0] == 2 * b[0]:
        return _likeness_of(a[1], b[2])
    return _likeness_of(a[2], b[1]) if b[0] == 2 * a[0] else 0.0


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_chars (code points) and fingerprint of every document row, whole texts; no shuffle.

    Null is the empty text, whose fingerprint has no symbols.  Equal texts have equal
    fingerprints.  Other columns are not read; an empty table gives no rows.
    """

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "n_chars": np.array([len(t) for t in batch["text"]], np.int64),
                "fingerprint": [written(fingerprint(t)) for t in batch["text"]],
            })

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
    return rows.mapInPandas(hashed, "doc_id long, n_chars long, fingerprint string")


def fingerprint_likeness(a: Column, b: Column) -> Column:
    """The likeness of two fingerprint columns, a double; null where either is null."""

    @F.pandas_udf("double")
    def compare(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else likeness(_read(p), _read(q)) for p, q in zip(x, y)], dtype="Float64")

    return compare(a, b)


def edited(text: str, after: str) -> str:
    """The text with its last half (rounded down) replaced by as many code points of the one after it, or all."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


_COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(doc_id: int | None, text: str, own: Fingerprint, after: str, next_: Fingerprint) -> tuple:
    changed = edited(text, after)
    other = fingerprint(changed)
    digest = hashlib.sha256(changed.encode("utf-8")).hexdigest()
    return doc_id, len(text), digest, written(own), written(other), likeness(own, other), likeness(own, next_)


def _framed(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    made = pd.DataFrame(rows, columns=columns)
    for c in ("doc_id", "n_chars"):
        made[c] = made[c].astype("Int64")
    return made


def edit_likeness(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one with the next doc_id, after the last the first; null
    ids come first, rows of one id follow a hash of their text, and equal rows are each
    other's next.  A null text is empty.  The edited text is ``edited(text, next text)``; near_edited is
    the likeness of the document's fingerprint to its, near_next that to the next
    document's.  A table of one row has itself as next; an empty one gives no rows.
    Other columns are not read.

    The rows are range-partitioned once by their order; each task reads its range in
    order with one row in hand.  Only the last row of a range has to wait for the
    first one of the next range; those, one each per range, are joined.
    """
    keyed = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"), text_key(text_column).alias("tie"),
    ).withColumn("row", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("row")]
    ranges = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text", F.spark_partition_id().alias("range"))

    def follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [*_COLUMNS, "range", "first_text", "last_text"]
        hand = None  # the row whose next has not come yet
        for batch in batches:
            rows = []
            for doc_id, text, range_ in zip(batch["doc_id"], batch["text"], batch["range"].tolist()):
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                print_ = fingerprint(text)
                if hand is None:
                    rows.append((*(None,) * 7, range_, text, None))
                else:
                    rows.append((*_compared(*hand, text, print_), range_, None, None))
                hand = doc_id, text, print_
            yield _framed(rows, columns)
        if hand is not None:
            yield _framed([(hand[0], *(None,) * 6, range_, None, hand[1])], columns)

    found = stored(ranges.mapInPandas(follow, f"{_SCHEMA}, range int, first_text string, last_text string"), "ranges")
    inner = found.where("first_text IS NULL AND last_text IS NULL").select(*_COLUMNS)
    # One row per range that has rows: a window over as many rows as there were tasks, without the texts.
    firsts = found.where("first_text IS NOT NULL").select("range")
    around = Window.orderBy("range")
    start = F.min("range").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    links = firsts.select(F.col("range").alias("here"), F.coalesce(F.lead("range").over(around), start).alias("there"))
    heads = found.where("first_text IS NOT NULL").select(F.col("range").alias("at"), F.col("first_text").alias("after"))
    lasts = found.where("last_text IS NOT NULL").select("doc_id", F.col("last_text").alias("text"), "range")
    waiting = lasts.join(links, F.col("range") == F.col("here")).join(heads, F.col("there") == F.col("at")).select("doc_id", "text", "after")

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield _framed([
                _compared(None if pd.isna(doc_id) else int(doc_id), text, fingerprint(text), after, fingerprint(after))
                for doc_id, text, after in zip(batch["doc_id"], batch["text"], batch["after"])
            ], _COLUMNS)

    return inner.union(waiting.mapInPandas(close, _SCHEMA))
