"""Periodic runs of words, found by seeds and extensions along diagonals.

A run of period q and length >= max(24, 3 q) agrees with itself q words on over at least
max(24 - q, 2 q) words.  Periods are taken in bands (1..16], (16..32], (32..64] ...; a run of
the band up to K agrees over at least K words, so the K-grams of a document index it.  As
K >= q, the next occurrence of a K-gram inside such a run is exactly q on: if it came
sooner, the run would have a smaller period.  So neighbouring occurrences no further apart
than K are all the seeds that are needed, and what they extend to has that smallest period.
Per lag a table of the furthest place covered suppresses seeds inside a run already extended.
All work is within a document; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import whole_text

MIN_WORDS = 24
MIN_REPEATS = 3
_STRIDE = 4096  # words compared at once while a diagonal is extended


def seed_size(min_words: int, min_repeats: int) -> int:
    """The longest gram that every run with a period up to its own length holds twice.

    The overlap of a run with itself, max(min_words - q, (min_repeats - 1) q), must be at least the
    gram for all q up to it.
    """
    size = 1
    while min(max(min_words - q, (min_repeats - 1) * q) for q in range(1, size + 2)) >= size + 1 and size < min_words:
        size += 1
    return size


def _paired(names: np.ndarray, step: int) -> np.ndarray:
    """Names of grams of twice the length; equal grams have equal names."""
    a, b = names[: len(names) - step], names[step:]
    keys = a * (int(b.max(initial=0)) + 1) + b
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def _grams(words: np.ndarray, size: int) -> np.ndarray:
    """Names of all ``size``-grams, by doubling; the last two parts may overlap."""
    names, length = words, 1
    while length * 2 <= size:
        names, length = _paired(names, length), length * 2
    return _paired(names, size - length) if length < size else names


def _seeds(names: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(lag, place) of neighbouring occurrences of a gram with low < lag <= high, sorted."""
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    place = order[:-1][same]
    lag = order[1:][same] - place
    near = (lag > low) & (lag <= high)
    place, lag = place[near], lag[near]
    by_lag = np.lexsort((place, lag))
    return lag[by_lag], place[by_lag]


def _extended(words: np.ndarray, place: int, lag: int) -> tuple[int, int]:
    """The stretch around ``place`` on which words agree with those ``lag`` on."""
    begin = place
    while begin:
        low = max(0, begin - _STRIDE)
        differ = np.flatnonzero(words[low:begin] != words[low + lag : begin + lag])
        if len(differ):
            begin = low + int(differ[-1]) + 1
            break
        begin = low
    end, last = place, len(words) - lag
    while end < last:
        high = min(last, end + _STRIDE)
        differ = np.flatnonzero(words[end:high] != words[end + lag : high + lag])
        if len(differ):
            end += int(differ[0])
            break
        end = high
    return begin, end


def find_runs(words: np.ndarray, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the word numbers, by start, then period.

    A run is a stretch of consecutive words whose smallest period q satisfies
    length >= max(min_words, min_repeats * q) and that no neighbouring word extends
    with that period.
    """
    found = []
    low, size = 0, seed_size(min_words, min_repeats)
    names = _grams(words, size) if len(words) >= max(min_words, size) else words[:0]
    while len(names) > 1:
        covered: dict[int, int] = {}  # per lag the end of the last stretch extended
        lags, places = _seeds(names, low, size)
        # Of seeds in a row on one diagonal the first stands for all.
        heads = np.r_[True, (lags[1:] != lags[:-1]) | (places[1:] != places[:-1] + 1)] if len(lags) else lags.astype(bool)
        for lag, place in zip(lags[heads].tolist(), places[heads].tolist()):
            if place < covered.get(lag, 0):
                continue
            begin, end = _extended(words, place, lag)
            covered[lag] = end
            length = end - begin + lag
            if length >= max(min_words, min_repeats * lag):
                found.append((begin, length, lag))
        if (min_repeats * (size + 1)) > len(words):
            break
        names = _paired(names, size)
        low, size = size, 2 * size
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """A flag per word: kept unless a run holds it after that run's first period."""
    steps = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:-1]) == 0


def _repeating(ids: np.ndarray, sizes: np.ndarray, size: int) -> np.ndarray:
    """A flag per document of a batch: whether any hash of a ``size``-gram occurs twice in it.

    Equal grams have equal hashes, so documents without the flag have no run.
    """
    if len(ids) < size:
        return np.zeros(len(sizes), bool)
    with np.errstate(over="ignore"):
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        grams, length = mixed, 1
        while length < size:
            step = min(length, size - length)
            grams = grams[: len(grams) - step] * np.uint64(0xBF58476D1CE4E5B9 + 2 * length) + grams[step:]
            length += step
        owner = np.repeat(np.arange(len(sizes)), sizes)
        inside = owner[: len(grams)] == owner[size - 1 :]
        of = owner[: len(grams)][inside]
        keys = grams[inside] * np.uint64(0x94D049BB133111EB) + of.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    order = np.argsort(keys)
    keys, of = keys[order], of[order]
    flags = np.zeros(len(sizes), bool)
    flags[of[1:][(keys[1:] == keys[:-1]) & (of[1:] == of[:-1])]] = True
    return flags


def planted_index(doc_id: int | None, n: int) -> np.ndarray | None:
    """The word that stands at each place once every tenth document's tail is made periodic; None for the others.

    With h = crc32 of the id in decimal and g = h // 10, documents with h % 10 = 0 repeat
    p = 1 + (n - a) // (3 + g % 8) words from a = g % n on.
    """
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    index = np.arange(n)
    index[a:] = a + (index[a:] - a) % p
    return index


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def periodic_runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", planted: bool = False,
    min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS, with_text: bool = False,
) -> DataFrame:
    """One row per document row: doc_id, n_runs, the greatest run's start, length, period and exponent_milli, runs_sha256, collapsed_sha256 [, runs, collapsed_text].

    Words are stretches without space and \\t to \\r, numbered from 0; null is a text
    without words.  The greatest run has the greatest exact length / period; of equal
    ones the least start, then the least period.  exponent_milli is
    floor(1000 length / period).  runs_sha256 is of every run's ``start,length,period`` and
    a line feed, by start, then period; collapsed_sha256 is of the words that no run
    repeats, joined by one space.  Without a run the four are null and the first digest
    is that of the empty text.  ``planted`` first makes the tail of every tenth
    document periodic (``planted_index``; a null id counts as the empty text).  Every row is worked through by
    itself, so repeated rows and ids give a row each; other columns are not read and an
    empty table gives no rows.  ``with_text`` adds the runs and the collapsed text.
    ``min_repeats`` must be 3 or more: with less, no gram of a period's length lies in a run twice.
    """
    if min_repeats < 3:
        raise ValueError("a run must hold its period three times at least")
    size = seed_size(min_words, min_repeats)

    def one(doc_id, words: list[bytes], numbers: np.ndarray | None) -> tuple:
        runs = find_runs(numbers, min_words, min_repeats) if numbers is not None else []
        kept = words
        if runs:
            kept = [words[i] for i in np.flatnonzero(collapsed(len(words), runs)).tolist()]
        text = b" ".join(kept)
        best = None
        for run in runs:
            if best is None or run[1] * best[2] > best[1] * run[2]:
                best = run
        shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
        row = (doc_id, len(runs), *shown, _sha(listed), _sha(text))
        return (*row, [list(run) for run in runs], text.decode("utf-8", "replace")) if with_text else row

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known: dict[bytes, int] = {}
            texts, numbers = [], []
            for doc_id, text in zip(batch.doc_id, batch.text):
                words = text.encode("utf-8").split()  # of bytes: at just these six characters
                index = planted_index(None if pd.isna(doc_id) else int(doc_id), len(words)) if planted else None
                if index is not None:
                    words = [words[i] for i in index.tolist()]
                texts.append(words)
                numbers.append(np.array([known.setdefault(w, len(known)) for w in words], np.int64))
            sizes = np.array([len(x) for x in numbers], np.int64)
            flags = _repeating(np.concatenate(numbers), sizes, size) if len(numbers) else []
            rows = [
                one(None if pd.isna(doc_id) else int(doc_id), words, x if flag else None)
                for doc_id, words, x, flag in zip(batch.doc_id, texts, numbers, flags)
            ]
            made = pd.DataFrame(rows, columns=columns)
            for c in ("doc_id", "start", "length", "period", "exponent_milli"):
                made[c] = made[c].astype("Int64")
            yield made

    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    schema = ", ".join(f"{c} {'string' if c.endswith('sha256') else 'long'}" for c in columns)
    if with_text:
        columns, schema = [*columns, "runs", "collapsed_text"], schema + ", runs array<array<long>>, collapsed_text string"
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
    return source.mapInPandas(search, schema)
