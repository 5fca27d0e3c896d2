"""Removal of long repeated byte strings by the phrases that they are made of.

Positions are thinned first: in every stretch of ``GAP`` positions the one whose
8 bytes hash lowest is an anchor, so equal stretches of text have equal anchors.  The
bytes from one anchor to the next are a phrase.  Phrases that occur once are a border:
no repeated string holds one.  Between borders, the run of phrases that holds all
strings starting in one phrase is looked up as a whole, once for each phrase.  What
repeats in whole phrases is then known.  Around the ends of those stretches single bytes
decide: a string of threshold length is a run of phrases with some bytes before and
after, and such strings are compared in full within their run.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import discard, id_key, stored, text_key, whole_text

LENGTH = 400
GAP = 160  # positions in which at least one is an anchor
GRAM = 8
SPLIT_ROWS = 4096  # contexts of one run that are compared in one group
_BLOCK = 1 << 17  # positions hashed at once
_TOGETHER = 1 << 20  # bytes of short texts searched together
_WINDOWS = 1 << 14  # stretches searched for their lowest place at once


def _ranks(data: bytes, begin: int, count: int) -> np.ndarray:
    """32 bits of hash for each 8 bytes from ``begin``."""
    grams = np.ndarray((count,), "<u8", data, begin, (1,)).copy()
    with np.errstate(over="ignore"):
        grams ^= grams >> np.uint64(31)
        grams *= np.uint64(0x9E3779B97F4A7C15)
    return np.ascontiguousarray(grams.view("<u4")[1::2])


def _anchors(data: bytes, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors x, the (rightmost) positions that hash lowest in a stretch of ``gap``, and for each the first stretch that has it so."""
    stretches = len(data) - GRAM - gap + 2
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for begin in range(0, stretches, _BLOCK):
        ranks = _ranks(data, begin, min(_BLOCK, stretches - begin) + gap - 1)
        low, width = ranks, 1
        while width * 2 <= gap:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < gap:
            low = np.minimum(low[: width - gap], low[gap - width :])
        # The lowest place changes where a place comes in that is as low, or where it is left behind.
        comes = ranks[gap - 1 :] == low
        comes[0] = False
        coming = np.flatnonzero(comes)
        leaving = np.r_[0, np.flatnonzero((low[1:] > low[:-1]) & ~comes[1:]) + 1]
        next_ = np.empty(len(leaving), np.int64)
        windows = np.lib.stride_tricks.sliding_window_view(ranks, gap)
        for k in range(0, len(leaving), _WINDOWS):
            at = leaving[k : k + _WINDOWS]
            next_[k : k + _WINDOWS] = at + gap - 1 - np.argmax((windows[at] == low[at, None])[:, ::-1], axis=1)
        lo = np.concatenate([leaving, coming])
        order = np.argsort(lo, kind="stable")
        x, lo = np.concatenate([next_, coming + gap - 1])[order] + begin, lo[order] + begin
        if found and found[-1][0][-1] == x[0]:  # goes on from the block before
            x, lo = x[1:], lo[1:]
        if len(x):
            found.append((x, lo))
    return tuple(np.concatenate(part) for part in zip(*found))


def _anchors_of(texts: list[bytes], gap: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """Each text with its ``_anchors``; short texts are searched together."""
    while texts:
        sizes = np.cumsum([len(t) for t in texts])
        count = max(1, int(np.searchsorted(sizes, _TOGETHER)))
        some, texts = texts[:count], texts[count:]
        x, lo = _anchors(b"".join(some), gap)
        begins = np.r_[0, sizes[: count - 1]]
        first = np.searchsorted(lo, begins, "right") - 1
        last = np.searchsorted(lo, sizes[:count] - GRAM - gap + 2)
        for data, begin, a, b in zip(some, begins.tolist(), first.tolist(), last.tolist()):
            yield data, x[a:b] - begin, np.maximum(lo[a:b] - begin, 0)


def _thinned(data: bytes, x: np.ndarray, lo: np.ndarray, length: int, gap: int) -> tuple[np.ndarray, ...]:
    """x and lo without the anchors inside long repetitions, and those repetitions: begin, end, period.

    Where one short word is repeated over and over, every repeat has an anchor.  Strings
    inside such a stretch of more than the threshold and a period occur again one period
    on, so no anchor is needed to know it; anchors stay where a string can reach out of
    the stretch, and at its begin, where its strings can be met by shorter stretches.
    """
    found: list[tuple[int, int, int]] = []
    keep = np.ones(len(x), bool)
    steps = np.diff(x)
    edges = np.r_[0, np.flatnonzero(steps[1:] != steps[:-1]) + 1, len(steps)]
    even = steps[edges[:-1]] if len(steps) else steps
    long = (even <= gap // 4) & (even * np.diff(edges)[: len(even)] > 2 * (length + even))
    for k in np.flatnonzero(long).tolist():
        period = int(even[k])
        margin = length + period
        begin, end = int(x[edges[k]]), int(x[edges[k + 1]])
        if data[begin : end - period] != data[begin + period : end]:
            continue
        while begin and data[begin - 1] == data[begin - 1 + period]:
            begin -= 1
        while end < len(data) and data[end] == data[end - period]:
            end += 1
        keep &= (x <= begin + margin) | (x >= end - margin)
        found.append((begin, end, period))
    begin, end, period = np.array(sorted(set(found)), np.int32).reshape(-1, 3).T
    return x[keep], lo[keep], begin, end, period


def _phrases(docs: DataFrame, id_column: str, text_column: str, length: int, gap: int) -> DataFrame:
    """Per text of at least ``length`` bytes: docno, keys, size, anchors x, their first stretch lo, long repetitions, phrase hashes."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            texts = [text.encode("utf-8") for text in batch.pop("text")]
            long = [len(data) >= length for data in texts]
            anchors = _anchors_of([data for data in texts if len(data) >= length], gap)
            for row, (data, x, lo) in zip(batch[long].itertuples(index=False), anchors):
                x, lo, begin, end, period = _thinned(data, x, lo, length, gap)
                ends = x.tolist()
                digests = b"".join([xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(ends, ends[1:])])
                halves = np.frombuffer(digests, "<i8").reshape(-1, 2)
                rows.append((row.docno, row.id_key, row.k1, row.k2, len(data), x.astype(np.int32), lo.astype(np.int32), begin, end, period, halves[:, 0], halves[:, 1]))
            yield pd.DataFrame(rows, columns=["docno", "id_key", "k1", "k2", "size", "x", "lo", "begin", "end", "period", "f1", "f2"])

    source = docs.select(
        F.monotonically_increasing_id().alias("docno"), id_key(id_column).alias("id_key"),
        text_key(text_column).alias("k1"), _second_key(text_column).alias("k2"), whole_text(text_column).alias("text"),
    )
    schema = "docno long, id_key long, k1 long, k2 long, size long, x array<int>, lo array<int>, begin array<int>, end array<int>, period array<int>, f1 array<long>, f2 array<long>"
    return stored(source.mapInPandas(cut, schema), "cut")


def _second_key(text_column: str) -> Column:
    """With ``text_key`` 128 bits that stand for a text: the same hash from another seed."""
    return F.xxhash64(F.lit(1), whole_text(text_column))


def _gathered(marks: DataFrame, schema: str) -> DataFrame:
    """One row per document with the other columns as arrays; sorted documents are worked through one by one."""
    columns = marks.columns[1:]

    def rows_of(parts: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(parts, ignore_index=True)
        docno = rows.docno.to_numpy()
        starts = np.flatnonzero(np.r_[True, docno[1:] != docno[:-1]])
        return pd.DataFrame({"docno": docno[starts]} | {c: np.split(rows[c].to_numpy(), starts[1:]) for c in columns})

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_: list[pd.DataFrame] = []  # rows of the document at the end of what was read
        for batch in batches:
            if not len(batch):
                continue
            last = int(np.searchsorted(batch.docno.to_numpy(), batch.docno.iat[-1]))
            if last or open_ and open_[-1].docno.iat[-1] != batch.docno.iat[0]:
                yield rows_of([*open_, batch.iloc[:last]])
                open_ = []
            open_.append(batch.iloc[last:])
        if open_:
            yield rows_of(open_)

    return marks.repartition("docno").sortWithinPartitions("docno").mapInPandas(gather, schema)


def _repeated_phrases(phrases: DataFrame) -> DataFrame:
    """docno and the arrays i, n: its phrases that occur again and how often they do.

    64 bits stand for a phrase: one taken for another only asks for more to be compared.
    Counting is a partial aggregate and the lookup a plain join, so a phrase in very many
    documents is no single task's work.
    """
    counts = phrases.select(F.explode("f1").alias("f")).groupBy("f").agg(F.count("*").alias("n")).where("n > 1")
    counts = stored(counts.withColumnRenamed("f", "phrase"), "counts")
    each = phrases.select("docno", F.posexplode("f1").alias("i", "f"))
    found = each.join(counts, each["f"] == counts["phrase"]).select("docno", "i", "n")
    marks = stored(_gathered(found, "docno long, i array<int>, n array<long>"), "marks", batch_rows=50_000)
    discard(counts)
    return marks


_PLACES = ["size", "x", "lo", "begin", "end", "period"]
_MARKS = ["i", "n"]
_RUNS = ["run_x", "run_y", "run_n", "canon"]
_LAYOUT = ["copies", *_PLACES, *_MARKS, *_RUNS]
_NO_RUNS = tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, bool))


def _chained(phrases: DataFrame, marks: DataFrame, length: int, gap: int) -> DataFrame:
    """The different texts that may have a repeated string, with their copies, and the runs to look up: from run_x to run_y, hash w1, w2.

    Equal texts are one row, that of the least docno, with their number: all of such a
    text goes, and the text itself is only needed to be met by others.
    """
    texts = phrases.groupBy("k1", "k2").agg(F.min("docno").alias("least"), F.count("*").alias("copies"))
    columns = ["docno", "spoken", "k1", "k2", "copies", *_PLACES, *_MARKS]

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                document = _Document(row.copies, *(getattr(row, c) for c in _PLACES + _MARKS), *_NO_RUNS, length, gap)
                if row.copies > 1 or document.promising():
                    i, j = document.runs_to_look_up()
                    prints = np.column_stack((row.f1, row.f2)).tobytes()
                    digests = b"".join([xxhash.xxh3_128_digest(prints[16 * a : 16 * b]) for a, b in zip(i.tolist(), j.tolist())])
                    w1, w2 = np.frombuffer(digests, "<i8").reshape(-1, 2).T
                    rows.append((*(getattr(row, c) for c in columns), row.x[i], row.x[j], w1, w2))
            yield pd.DataFrame(rows, columns=[*columns, "run_x", "run_y", "w1", "w2"])

    schema = (
        "docno long, spoken long, k1 long, k2 long, copies long, size long, x array<int>, lo array<int>, begin array<int>, end array<int>, period array<int>,"
        " i array<int>, n array<long>, run_x array<int>, run_y array<int>, w1 array<long>, w2 array<long>"
    )
    first = phrases.withColumnRenamed("id_key", "spoken").join(texts.select("least", "copies"), F.col("docno") == F.col("least"))
    return stored(first.join(marks, "docno").select(*columns, "f1", "f2").mapInPandas(chain, schema), "chained")


def _repeated_runs(chained: DataFrame) -> DataFrame:
    """docno and the arrays run_x, run_y, run_n, canon: its runs that occur again, how often they do, whether they stand for all copies.

    canon marks one occurrence (two, should the hash of their places agree).
    """
    place = F.xxhash64("docno", "run_x")
    each = chained.select("docno", "copies", F.explode(F.arrays_zip("run_x", "run_y", "w1", "w2")).alias("run")).select("docno", "copies", "run.*")
    groups = each.groupBy(F.col("w1").alias("a1"), F.col("w2").alias("a2")).agg(F.sum("copies").alias("run_n"), F.min(place).alias("first"))
    counts = stored(groups.where("run_n > 1"), "run-counts")
    found = each.join(counts, (each["w1"] == counts["a1"]) & (each["w2"] == counts["a2"])).select(
        "docno", "run_x", "run_y", "run_n", (place == F.col("first")).alias("canon"),
    )
    schema = "docno long, run_x array<int>, run_y array<int>, run_n array<long>, canon array<boolean>"
    runs = stored(_gathered(found, schema), "runs", batch_rows=50_000)
    discard(counts)
    return runs


class _Document:
    """What the counts say about the strings of one text of ``size`` bytes that ``copies`` documents have."""

    def __init__(self, copies, size, x, lo, begin, end, period, i, n, run_x, run_y, run_n, canon, length: int, gap: int):
        self.copies, self.size, self.x, self.lo, self.length = copies, size, x.astype(np.int64), lo.astype(np.int64), length
        self.reach = length - GRAM - gap + 1  # from the first stretch of a string to its last
        self.starts = size - length + 1
        self.counts = np.zeros(len(x), np.int64)  # of each phrase, 0 where it occurs once
        self.counts[i] = n
        self.runs = run_x, run_y - length + 1, run_n, canon.astype(bool)
        # The strings of a long repetition are known; those of its first period stand for all.
        self.repetitions = begin, end - length + 1
        self.first_periods = begin, begin + period

    @cached_property
    def known(self) -> np.ndarray:
        """Whether the string at a start lies in a run or a repetition that says it occurs again."""
        if self.copies > 1:
            return np.ones(self.starts, bool)
        return self._cover(np.r_[self.runs[0], self.repetitions[0]], np.r_[self.runs[1], self.repetitions[1]])

    def _cover(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The starts from any begin to before its end."""
        steps = np.bincount(begin, minlength=self.starts + 1) - np.bincount(end, minlength=self.starts + 1)
        return np.cumsum(steps[:-1]) > 0

    def runs_to_look_up(self) -> tuple[np.ndarray, np.ndarray]:
        """Anchors from and to: per phrase the run of repeated ones that holds all strings that start in it.

        Before a border the run is shorter, down to the threshold.  Shorter ones and
        those that meet a longer one elsewhere are left to the comparison of strings.
        """
        border = np.where(self.counts[:-1] > 0, len(self.x) - 1, np.arange(len(self.x) - 1))
        border = np.minimum.accumulate(border[::-1])[::-1]
        i = np.flatnonzero(self.counts[:-1])
        j = np.minimum(np.searchsorted(self.x, self.x[i + 1] + self.length - 1), border[i])
        long = self.x[j] - self.x[i] >= self.length
        return i[long], j[long]

    @cached_property
    def _stretches(self) -> tuple[np.ndarray, ...]:
        """Starts s..e-1 whose strings go from anchor i to anchor j, whether all its phrases repeat."""
        cuts = np.concatenate([[0], self.lo, self.lo - self.reach])
        cuts = np.sort(cuts[(cuts >= 0) & (cuts < self.starts)])
        s = cuts[np.r_[True, cuts[1:] != cuts[:-1]]]
        i = np.searchsorted(self.lo, s, "right") - 1
        j = np.searchsorted(self.lo, s + self.reach, "right") - 1
        before = np.r_[0, np.cumsum(self.counts == 0)]
        e = np.r_[s[1:], self.starts]
        # In the middle of a long repetition the anchors before a string are not in it.
        within = (self.x[i] >= e - 1) & (self.x[j] >= e - 1 + self.reach)
        return s, e, i, j, within & (before[j] == before[i])

    def promising(self) -> bool:
        """Whether the text may have a repeated string, from its phrases alone: one whose anchors are in one run between borders."""
        ends = np.flatnonzero(np.diff(np.r_[False, self.counts > 0, False]))
        after = np.r_[self.lo, self.lo[-1] + self.size + self.reach][ends[1::2] + 1]
        return len(self.repetitions[0]) > 0 or bool((self.lo[ends[::2]] < np.minimum(after - self.reach, self.starts)).any())

    def stretches(self) -> list[tuple[int, int, int, int, bool]]:
        """(s, e, a, b, ask): the starts s..e-1 whose strings share the bytes from a to b, an anchor each.

        Only runs of repeated phrases, and only where some start is undecided (ask) or
        stands for all copies of a known run.  The latter is left out where the inner
        run occurs no oftener than the known one: then each of its copies lies in a copy
        of the known run, and none of them can be undecided.
        """
        s, e, i, j, chained = self._stretches
        ask = np.bitwise_or.reduceat(~self.known, s)
        most = np.zeros(self.starts, np.int64)  # copies of a known run here; -1 where no start stands for any
        begin, end, count, canon = self.runs
        use = ask
        if self.copies > 1 or canon.any() or len(self.first_periods[0]):
            shown = self._cover(begin[canon], end[canon]) | self._cover(*self.first_periods)
            use = ask | np.bitwise_or.reduceat(shown, s) | (self.copies > 1)
            order = np.argsort(count, kind="stable")
            for a, b, n in zip(begin[order].tolist(), end[order].tolist(), count[order].tolist()):
                most[a:b] = n
            for a, b in zip(*(v.tolist() for v in self.first_periods)):
                most[a:b] = 0
            if self.copies > 1:
                most = np.maximum(most, self.copies)
        use = np.flatnonzero(use & chained)
        if not len(use):
            return []
        counts, x = self.counts.tolist(), self.x.tolist()
        least = np.minimum.reduceat(most, s)[use]
        out = []
        for s, e, i, j, ask, copies in zip(*(v[use].tolist() for v in (s, e, i, j, ask)), least.tolist()):
            if ask or copies < min(counts[i:j]):
                out.append((s, e, x[i], x[j], ask))
        return out


def _documents(batch: pd.DataFrame, length: int, gap: int) -> Iterator[_Document]:
    return (_Document(*v, length, gap) for v in zip(*(batch[c] for c in _LAYOUT)))


_CONTEXT = ["key", "before", "after", "least"]


def _contexts(candidates: DataFrame, length: int, gap: int) -> DataFrame:
    """Per stretch of starts its run (128 bits and its size), the bytes around it, and where it is.

    A string starts ``d`` bytes before its run, least <= d <= len(before); it ends with
    the first room - d bytes after the run, where room = len(after) + least.  h1, h2 are
    a digest of the context.
    """

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made: dict[str, list] = {c: [] for c in [*_CONTEXT, "docno", "s", "ask", "copies"]}
            key_, before_, after_, least_, docno_, s_, ask_, copies_ = (made[c].append for c in made)
            digests = []
            for text, docno, document in zip(batch.text, batch.docno, _documents(batch, length, gap)):
                data = text.encode("utf-8")
                for s, e, a, b, ask in document.stretches():
                    key = xxhash.xxh3_128_digest(data[a:b]) + (b - a).to_bytes(8, "little")
                    before, after, least = data[s:a], data[b : e - 1 + length], a - e + 1
                    sizes = len(key) << 64 | len(before) << 32 | least
                    digests.append(xxhash.xxh3_128_digest(sizes.to_bytes(16, "little") + key + before + after))
                    key_(key), before_(before), after_(after), least_(least)
                    docno_(docno), s_(s), ask_(ask), copies_(document.copies)
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield pd.DataFrame(made | {"h1": halves[:, 0], "h2": halves[:, 1]})

    schema = "key binary, before binary, after binary, least int, docno long, s int, ask boolean, copies long, h1 long, h2 long"
    return candidates.select("docno", "text", *_LAYOUT).mapInPandas(emit, schema)


def _strings(before: bytes, after: bytes, least: int) -> Iterator[tuple[int, bytes]]:
    room = len(after) + least
    for d in range(least, len(before) + 1):
        yield d, before[len(before) - d :] + after[: room - d]


def _ranges(ds: list[int]) -> list[tuple[int, int]]:
    """Ascending numbers as closed ranges."""
    v = np.array(ds)
    edge = np.flatnonzero(np.diff(v) > 1)
    return list(zip(v[np.r_[0, edge + 1]].tolist(), v[np.r_[edge, len(v) - 1]].tolist()))


def _common_start(a: bytes, b: bytes) -> int:
    """Bytes that both begin with."""
    size = min(len(a), len(b))
    differ = int.from_bytes(a[:size], "little") ^ int.from_bytes(b[:size], "little")
    return size if not differ else ((differ & -differ).bit_length() - 1) // 8


def _common_end(a: bytes, b: bytes) -> int:
    size = min(len(a), len(b))
    return _common_start(a[len(a) - size :][::-1], b[len(b) - size :][::-1])


Context = tuple[bytes, bytes, int, bool]  # before, after, least, open


def _repeated_by_pairs(contexts: list[Context]) -> Iterator[tuple[int, int, int]]:
    """(position, from, to) of each open context and each other one: a d is common if both sides agree so far."""
    for p, (before, after, least, open_) in enumerate(contexts):
        room = len(after) + least
        for other_before, other_after, other_least, _ in contexts[:p] + contexts[p + 1 :] if open_ else []:
            high = _common_end(before, other_before)
            low = max(least, other_least, room - _common_start(after, other_after))
            if low <= high:
                yield p, low, high


def _repeated_by_strings(contexts: list[Context]) -> Iterator[tuple[int, int, int]]:
    """The same for many contexts: strings are counted."""
    seen: dict[tuple[int, bytes], int] = {}
    for before, after, least, _ in contexts:
        for string in _strings(before, after, least):
            seen[string] = seen.get(string, 0) + 1
    for p, (before, after, least, open_) in enumerate(contexts):
        twice = [s[0] for s in _strings(before, after, least) if seen[s] > 1] if open_ else []
        for low, high in _ranges(twice) if twice else []:
            yield p, low, high


_FOUND = "h1 long, h2 long, from int, to int"
_PAIRS = 12  # contexts up to which pairs are cheaper than strings


def _compare_groups(contexts: DataFrame) -> DataFrame:
    """The ranges of d whose string occurs in another context of the same run; sorted runs are worked through one by one."""

    def repeated(keys: list, rows: list[tuple]) -> pd.DataFrame:
        out, start = [], 0
        for end in range(1, len(keys) + 1):
            if end < len(keys) and keys[end] == keys[start]:
                continue
            group = rows[start:end]
            find = _repeated_by_pairs if len(group) <= _PAIRS else _repeated_by_strings
            out += [(*group[p][:2], low, high) for p, low, high in find([row[2:] for row in group])]
            start = end
        return pd.DataFrame(out, columns=["h1", "h2", "from", "to"])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys: list = []
        rows: list[tuple] = []
        for batch in batches:
            keys += batch.key.tolist()
            rows += zip(batch.h1.tolist(), batch.h2.tolist(), batch.before, batch.after, batch.least.tolist(), batch.open.tolist())
            last = len(keys) - 1
            while last > 0 and keys[last - 1] == keys[-1]:
                last -= 1
            yield repeated(keys[:last], rows[:last])
            keys, rows = keys[last:], rows[last:]
        yield repeated(keys, rows)

    return contexts.repartition("key").sortWithinPartitions("key").mapInPandas(compare, _FOUND)


def _compare_strings(contexts: DataFrame) -> DataFrame:
    """The same for runs with very many contexts: each string is a row, counted by a partial aggregate."""

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                for d, string in _strings(row.before, row.after, row.least):
                    digest = xxhash.xxh3_128_digest(row.key + d.to_bytes(8, "little") + string)
                    rows.append((*np.frombuffer(digest, "<i8").tolist(), row.h1, row.h2, d, row.open))
            yield pd.DataFrame(rows, columns=["w1", "w2", "h1", "h2", "d", "open"])

    strings = contexts.mapInPandas(spread, "w1 long, w2 long, h1 long, h2 long, d int, open boolean")
    twice = strings.groupBy(F.col("w1").alias("a1"), F.col("w2").alias("a2")).agg(F.count("*").alias("n")).where("n > 1")
    found = strings.where("open").join(twice, (F.col("w1") == F.col("a1")) & (F.col("w2") == F.col("a2")))
    return found.select("h1", "h2", F.col("d").alias("from"), F.col("d").alias("to"))


def _repeated_starts(candidates: DataFrame, length: int, gap: int, split_rows: int) -> DataFrame:
    """docno and ``spans`` (lo, hi): the undecided starts whose string occurs again."""
    contexts = stored(_contexts(candidates, length, gap), "contexts")
    distinct = stored(
        contexts.groupBy("h1", "h2", *_CONTEXT).agg(F.sum("copies").alias("m"), F.max("ask").alias("ask"))
        .withColumn("open", F.col("ask") & (F.col("m") == 1)), "distinct"
    )
    # Only runs with an open context and another one need comparing.
    sizes = distinct.groupBy("key").agg(F.count("*").alias("size"), F.max("open").alias("any")).where("size > 1 AND any")
    sizes = stored(sizes.select(F.col("key").alias("run"), "size"), "sizes")
    some = distinct.join(sizes.where(F.col("size") <= split_rows), distinct["key"] == F.col("run"), "left_semi")
    many = distinct.join(sizes.where(F.col("size") > split_rows), distinct["key"] == F.col("run"), "left_semi")
    full = distinct.where("m > 1 AND ask").select("h1", "h2", F.col("least").alias("from"), F.length("before").alias("to"))
    found = stored(_compare_groups(some).union(_compare_strings(many)).union(full), "found")
    asked = contexts.where("ask").select(
        F.col("h1").alias("c1"), F.col("h2").alias("c2"), "docno", (F.col("s") + F.length("before")).alias("a")
    )
    spans = asked.join(found, (asked["c1"] == found["h1"]) & (asked["c2"] == found["h2"])).select(
        F.col("docno").alias("doc"), F.struct((F.col("a") - F.col("to")).alias("lo"), (F.col("a") - F.col("from")).alias("hi")).alias("span")
    )
    gathered = spans.groupBy("doc").agg(F.collect_list("span").alias("spans"))
    kept = stored(gathered.select("doc", F.col("spans.lo").alias("span_lo"), F.col("spans.hi").alias("span_hi")), "spans")
    discard(contexts, distinct, sizes, found)
    return kept


def _removed(document: _Document, span_lo, span_hi) -> np.ndarray:
    """A flag per byte."""
    repeated = document.known
    if span_lo is not None:
        repeated = repeated | document._cover(span_lo, span_hi + 1)
    starts = np.flatnonzero(repeated)
    steps = np.zeros(document.size + 1, np.int64)
    steps[starts] += 1
    steps[starts + document.length] -= 1
    return np.cumsum(steps[:-1]) > 0


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    length: int = LENGTH, gap: int = GAP, split_rows: int = SPLIT_ROWS, with_text: bool = False,
) -> DataFrame:
    """One row per document row: doc_id, id_key, text_key, n_bytes, n_removed, n_spans, kept_sha256 [, kept_text].

    Texts are UTF-8 bytes (null: none).  Every byte of every ``length``-byte string that
    also starts anywhere else, in another row or the same one, overlaps included, is
    removed; strings are judged on the input.  Rows that repeat one text are
    documents of their own, so all of a long repeated text goes.  kept_text is what is
    left; halves of characters that a cut leaves are dropped from it, not from the
    digest.  Texts shorter than ``length`` stay.  Other columns are not read; an empty
    table gives no rows.  2 * gap + 7 must not exceed ``length``.
    """
    if 2 * gap + GRAM - 1 > length or gap < 2:
        raise ValueError("a string of the given length must hold two anchors")
    phrases = _phrases(docs, id_column, text_column, length, gap)
    marks = _repeated_phrases(phrases)
    chained = _chained(phrases, marks, length, gap)
    discard(phrases, marks)
    runs = _repeated_runs(chained)
    wanted = chained.drop(*_RUNS[:2], "w1", "w2").join(runs, "docno", "left").withColumns(
        {c: F.coalesce(c, F.array().cast(runs.schema[c].dataType)) for c in _RUNS}
    )
    source = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), id_key(id_column).alias("id_key"), text_key(text_column).alias("text_key"),
        _second_key(text_column).alias("second"), whole_text(text_column).alias("text"),
    )
    joined = source.join(wanted, (source["text_key"] == wanted["k1"]) & (source["second"] == wanted["k2"]), "left")
    # A text of several documents is read once more at most, from the row that speaks for it.
    several = F.coalesce(F.col("copies") > 1, F.lit(False))
    read = F.col("docno").isNotNull() & (~several | (F.col("id_key") == F.col("spoken")))
    parted = stored(joined.select(
        "doc_id", "id_key", "text_key", "docno", *_LAYOUT, several.alias("several"), read.alias("read"),
        F.octet_length("text").cast("long").alias("n_bytes"), F.when(F.col("docno").isNull(), F.sha2("text", 256)).alias("whole_sha256"),
        F.when(read | (F.lit(with_text) & ~several), F.col("text")).alias("text"),
    ), "parted")
    discard(chained, runs)
    spans = _repeated_starts(parted.where("read"), length, gap, split_rows)
    candidates = parted.where("read AND NOT several")
    told = candidates.join(spans, candidates["docno"] == spans["doc"], "left")
    columns = ["doc_id", "id_key", "text_key", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept_text"] * with_text

    def strip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row, document in zip(batch.itertuples(index=False), _documents(batch, length, gap)):
                gone = _removed(document, row.span_lo, row.span_hi)
                left = np.frombuffer(row.text.encode("utf-8"), np.uint8)[~gone].tobytes()
                spans = int((gone & ~np.r_[False, gone[:-1]]).sum())
                made = (row.doc_id, row.id_key, row.text_key, row.n_bytes, int(gone.sum()), spans, hashlib.sha256(left).hexdigest())
                rows.append((*made, left.decode("utf-8", errors="ignore")) if with_text else made)
            yield pd.DataFrame(rows, columns=columns)

    schema = "doc_id long, id_key long, text_key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * with_text
    stripped = told.select(
        "doc_id", "id_key", "text_key", "n_bytes", *_LAYOUT, "text", "span_lo", "span_hi"
    ).mapInPandas(strip, schema)

    def where_several(then: Column, otherwise: Column, name: str) -> Column:
        return F.when(F.col("several"), then).otherwise(otherwise).alias(name)

    zero = F.lit(0).cast("long")
    decided = parted.where("several OR docno IS NULL").select(
        "doc_id", "id_key", "text_key", "n_bytes", where_several(F.col("n_bytes"), zero, "n_removed"),
        where_several(F.lit(1).cast("long"), zero, "n_spans"),
        where_several(F.sha2(F.lit(""), 256), F.col("whole_sha256"), "kept_sha256"),
        *([where_several(F.lit(""), F.col("text"), "kept_text")] * with_text),
    )
    return decided.union(stripped)


def drop_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH, gap: int = GAP,
) -> DataFrame:
    """``docs`` with the repeated strings cut out of the text, all other columns as they were.

    Every row stays, also one whose text is all cut; null texts stay null.  Of rows
    that repeat a text of at least ``length`` bytes nothing is left in any; an empty table stays empty.
    """
    kept = remove_repeats(docs, id_column, text_column, length, gap, with_text=True)
    left = kept.groupBy(F.col("id_key").alias("_i"), F.col("text_key").alias("_k")).agg(F.max("kept_text").alias("_left"))
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_column]).alias("_rest"),
                       id_key(id_column).alias("_id"), text_key(text_column).alias("_text"), F.col(text_column).isNull().alias("_null"))
    joined = wide.join(left, (wide["_id"] == left["_i"]) & (wide["_text"] == left["_k"]))
    text = F.when(~F.col("_null"), F.col("_left")).alias(text_column)
    return joined.select(*[text if c == text_column else F.col(f"_rest.`{c}`") for c in docs.columns])
