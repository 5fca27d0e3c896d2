"""Alignment of two tokenizers with corpus-wide counts of linked ids, by external spill counting.

Tasks read documents in chunks of a few megabytes.  A chunk's linked pairs become records
(A id, B id, document, times), one for each pair and document, sorted and dealt by radix of
the A id into compressed runs.  The head of a run holds its pairs and in how many of the
chunk's documents each occurs; only heads are merged.  A merge takes a bounded number of
runs through a heap, in order of the A id and then the B id, and writes one run; merges of
merges follow until a radix is one run.  As that is in order of the A id, the highest count of each is
known when its last pair has passed.  Then the finished runs go back to the chunks' runs of
their radix, group by group, and every document gets what its records contribute.

A pair in very many documents is one entry of a head per chunk, so no A id and no pair is
one task's work, and the runs of a radix are taken in groups of a bounded number.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import sentencepiece
import tiktoken
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .base import discard, ship_file, shipped_file, stored, whole_text
from .packing import LONG_WORD
from .vocabulary import OTHER_CODE_POINTS, PATTERN, vocabulary

RADIX = 32  # parts by A id
FAN_IN = 64  # runs of one merge, on average
CHUNK_BYTES = 4 << 20  # text of one chunk, about
CHUNK_ROWS = 1 << 16
BLOCK = 1 << 13  # pairs of a head that are in memory at once for each run
_LONG = re.compile(r"\S{%d}|\s{%d}" % (LONG_WORD, LONG_WORD))
_BYTE = re.compile("<0x([0-9A-F]{2})>")


class ByteLevel:
    """Ids and token bytes of a byte-level BPE file; special strings are plain text.

    The fast merger is used where it equals the library (see ``packing.Encoder``).
    """

    def __init__(self, path: str):
        vocab = vocabulary(path)
        ordered = np.array_equal(np.sort(vocab.made_by), vocab.made_by) and vocab.made_by.min() > vocab.byte_ids.max()
        self.fast = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=vocab.id_of, special_tokens={}) if ordered else None
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.bytes_of = [vocab.bytes_of.get(i, b"") for i in range(vocab.size)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._one(t) for t in texts]

    def _one(self, text: str) -> list[int]:
        if self.fast is None or OTHER_CODE_POINTS.search(text) or _LONG.search(text):
            return self.library.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class Pieces:
    """Ids and token bytes of a sentence-piece model, which puts the leading space itself."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of = []
        for i in range(self.model.vocab_size()):
            piece = self.model.id_to_piece(i)
            byte = _BYTE.fullmatch(piece)
            self.bytes_of.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode("utf-8"))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Aligner:
    """Both tokenizers and what is looked up per id."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.size_a, self.size_b = (np.array([len(x) for x in side.bytes_of], np.int64) for side in (self.a, self.b))
        # The digits of an id with what follows it: within its side, or at the side's end.
        self.shown = [b"%d%c" % (i, end) for i in range(len(self.size_a)) for end in b",|"]
        self.shown += [b"%d%c" % (i, end) for i in range(len(self.size_b)) for end in b",;"]

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides; none for texts whose token bytes differ from a space and the text."""
        spaced = [" " + t if t else "" for t in texts]
        sides = self.a.encode(spaced), self.b.encode(texts)
        for k, text in enumerate(spaced):
            data = text.encode("utf-8")
            for side, ids in zip((self.a, self.b), sides):
                if b"".join(map(side.bytes_of.__getitem__, ids[k])) != data:
                    sides[0][k] = sides[1][k] = []
                    break
        return sides


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One per process."""
    return Aligner(path_a, path_b)


class Alignment:
    """Groups and links of a chunk of texts, in arrays over all their tokens."""

    def __init__(self, texts: list[str], tools: Aligner):
        self.docs, self.shown, self.split = len(texts), tools.shown, len(tools.size_a)
        ids = tools.encode(texts)
        (self.a, self.of_a), (self.b, self.of_b) = map(self._flat, ids)
        # Both sides of a document have the same bytes, so places run on over all documents.
        ends_a, ends_b = np.cumsum(tools.size_a[self.a]), np.cumsum(tools.size_b[self.b])
        ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        ends = ends[np.r_[True, ends[1:] != ends[:-1]]] if len(ends) else ends
        # Two tokens overlap in one stretch, and each stretch between ends lies in one token of either side.
        self.link_a, self.link_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        self.last_a = ends_b[np.searchsorted(ends_b, ends_a)] == ends_a if len(ends) else np.empty(0, bool)
        self.last_b = ends_a[np.searchsorted(ends_a, ends_b)] == ends_b if len(ends) else np.empty(0, bool)

    @staticmethod
    def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        sizes = [len(x) for x in ids]
        flat = np.fromiter((i for x in ids for i in x), np.int64, sum(sizes))
        return flat, np.repeat(np.arange(len(ids)), sizes)

    def counts(self) -> dict[str, np.ndarray]:
        count = lambda owner: np.bincount(owner, minlength=self.docs)
        return {
            "n_a": count(self.of_a), "n_b": count(self.of_b), "n_groups": count(self.of_a[self.last_a]),
            "n_links": count(self.of_a[self.link_a]),
        }

    def groups(self) -> list[bytes]:
        """Per document ``a1,a2|b1;a3|b2,b3``: the ids of its groups."""
        end_a, end_b = np.flatnonzero(self.last_a) + 1, np.flatnonzero(self.last_b) + 1
        group_a, group_b = np.cumsum(self.last_a) - self.last_a, np.cumsum(self.last_b) - self.last_b
        place_a = np.arange(len(self.a)) + np.r_[0, end_b][group_a]
        place_b = np.arange(len(self.b)) + np.r_[end_a, 0][group_b]
        shown = np.empty(len(self.a) + len(self.b), np.int64)
        shown[place_a] = 2 * self.a + self.last_a
        shown[place_b] = 2 * (self.split + self.b) + self.last_b
        sizes = np.bincount(self.of_a, minlength=self.docs) + np.bincount(self.of_b, minlength=self.docs)
        bounds = np.r_[0, np.cumsum(sizes)].tolist()
        out = []
        for begin, end in zip(bounds, bounds[1:]):
            out.append(b"".join(map(self.shown.__getitem__, shown[begin:end].tolist()))[:-1])
        return out

    def records(self, size_a: int, size_b: int, radix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes, documents and times of the linked pairs, sorted; a code is in order of radix, A id, B id."""
        a, b = self.a[self.link_a], self.b[self.link_b]
        keys = (pair_code(a, b, size_a, size_b, radix) * self.docs + self.of_a[self.link_a]).astype(np.uint64)
        keys.sort()
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
        times = np.diff(np.r_[first, len(keys)])
        keys = keys[first].astype(np.int64)
        return keys // self.docs, keys % self.docs, times


def pair_code(a: np.ndarray, b: np.ndarray, size_a: int, size_b: int, radix: int) -> np.ndarray:
    """One number per pair that sorts by the radix of the A id, the A id, the B id."""
    return (a % radix * -(-size_a // radix) + a // radix) * size_b + b


def _packed(*columns: np.ndarray) -> bytes:
    """Arrays of non-negative numbers, each in the fewest bytes it needs, compressed."""
    parts = []
    for column in columns:
        kind = np.dtype(np.min_scalar_type(int(column.max(initial=0))))
        parts += [struct.pack("<cq", kind.char.encode(), len(column)), column.astype(kind).tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpacked(data: bytes) -> list[np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(data):
        kind, size = struct.unpack_from("<cq", data, at)
        column = np.frombuffer(data, np.dtype(kind.decode()), size, at + 9)
        out.append(column.astype(np.int64))
        at += 9 + column.nbytes
    return out


def write_run(codes: np.ndarray, counts: np.ndarray) -> bytes:
    """A head: blocks of ascending codes, as steps, with their counts; each block compressed by itself."""
    out = []
    for begin in range(0, len(codes), BLOCK):
        part = codes[begin : begin + BLOCK]
        block = _packed(np.diff(part, prepend=0), counts[begin : begin + BLOCK])
        out += [struct.pack("<I", len(block)), block]
    return b"".join(out)


def read_run(head: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The blocks of a head, decompressed one by one."""
    at = 0
    while at < len(head):
        (size,) = struct.unpack_from("<I", head, at)
        steps, counts = _unpacked(head[at + 4 : at + 4 + size])
        yield np.cumsum(steps), counts
        at += 4 + size


def merge_runs(heads: list[bytes]) -> bytes:
    """One run of all pairs of several runs, counts added: a heap holds one pair of each."""

    def pairs(head: bytes) -> Iterator[tuple[int, int]]:
        for codes, counts in read_run(head):
            yield from zip(codes.tolist(), counts.tolist())

    merged, codes, counts = [], [], []
    last = -1
    for code, count in heapq.merge(*map(pairs, heads)):
        if code == last:
            counts[-1] += count
            continue
        if len(codes) == BLOCK:
            merged.append(write_run(np.array(codes), np.array(counts)))
            codes, counts = [], []
        codes.append(code)
        counts.append(count)
        last = code
    return b"".join([*merged, write_run(np.array(codes, np.int64), np.array(counts, np.int64))])


def finished(head: bytes, size_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes and counts of a radix, and whether a count is the highest of its A id."""
    blocks = list(read_run(head))
    codes, counts = (np.concatenate(x) for x in zip(*blocks))
    side = codes // size_b
    starts = np.flatnonzero(np.r_[True, side[1:] != side[:-1]])
    highest = np.repeat(np.maximum.reduceat(counts, starts), np.diff(np.r_[starts, len(codes)]))
    return codes, counts, counts == highest


_FACTS = ["n_a", "n_b", "n_groups", "n_links"]
_CHUNK = "chunk long, radix int, head binary, body binary, rows int, doc_id array<long>, " + ", ".join(
    f"{c} array<long>" for c in _FACTS) + ", groups_sha256 array<string>"


def _chunks(docs: DataFrame, name_a: str, name_b: str, radix: int, chunk_bytes: int, id_column: str, text_column: str) -> DataFrame:
    """Per chunk one row of its documents' own figures (radix -1) and a run for each radix it has pairs in."""

    def rows_of(chunk: int, ids: list, texts: list[str]) -> pd.DataFrame:
        tools = aligner(shipped_file(name_a), shipped_file(name_b))
        size_a, size_b = len(tools.size_a), len(tools.size_b)
        found = Alignment(texts, tools)
        facts = {c: n.tolist() for c, n in found.counts().items()}
        digests = [hashlib.sha256(g).hexdigest() if g else "" for g in found.groups()]
        rows = [(chunk, -1, None, None, len(ids), ids, *facts.values(), digests)]
        codes, of, times = found.records(size_a, size_b, radix)
        part = codes // (-(-size_a // radix) * size_b)
        bounds = np.searchsorted(part, np.arange(radix + 1)).tolist()
        for r, (begin, end) in enumerate(zip(bounds, bounds[1:])):
            if begin == end:
                continue
            own = codes[begin:end]
            starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            head = write_run(own[starts], np.diff(np.r_[starts, len(own)]))
            rows.append((chunk, r, head, _packed(of[begin:end], times[begin:end]), len(ids), *(None,) * 6))
        return pd.DataFrame(rows, columns=["chunk", "radix", "head", "body", "rows", "doc_id", *_FACTS, "groups_sha256"])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunk, ids, texts, size = 0, [], [], 0
        for batch in batches:
            for row, doc_id, text in zip(batch["row"].tolist(), batch["doc_id"], batch["text"]):
                if not ids:
                    chunk = row
                ids.append(None if pd.isna(doc_id) else int(doc_id))
                texts.append(text)
                size += len(text)
                if size >= chunk_bytes or len(ids) >= CHUNK_ROWS:
                    yield rows_of(chunk, ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield rows_of(chunk, ids, texts)

    source = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"),
    )
    return stored(source.mapInPandas(cut, _CHUNK), "chunks")


def _salted(df: DataFrame, groups: int) -> DataFrame:
    return df.withColumn("salt", F.pmod(F.xxhash64("chunk"), F.lit(groups)).cast("int"))


def _merged(runs: DataFrame, chunks: int, fan_in: int) -> DataFrame:
    """radix and the head that holds all its pairs."""

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"chunk": [int(key[1])], "radix": [int(key[0])], "head": [merge_runs(group["head"].tolist())]})

    level, before = 0, None
    current = runs.select("chunk", "radix", "head")
    while True:
        level += 1
        chunks = -(-chunks // fan_in)
        made = _salted(current, chunks).groupBy("radix", "salt").applyInPandas(merge, "chunk long, radix int, head binary")
        current = stored(made, f"merged-{level}")
        if before is not None:
            discard(before)
        if chunks <= 1:
            return current.select("radix", "head")
        before = current


def _contributions(runs: DataFrame, merged: DataFrame, groups: int, size_b: int) -> DataFrame:
    """Per chunk and radix, for each of its documents, links at the highest count and the sum of counts."""

    def give(key: tuple, own: pd.DataFrame, whole: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(own):
            codes, counts, highest = finished(whole["head"].iloc[0], size_b)
            for chunk, radix, head, body, docs in zip(own["chunk"], own["radix"], own["head"], own["body"], own["rows"]):
                pairs, sizes = (np.concatenate(x) for x in zip(*read_run(head)))
                at = np.repeat(np.searchsorted(codes, pairs), sizes)
                of, times = _unpacked(body)
                best, total = np.zeros((2, docs), np.int64)
                np.add.at(best, of, times * highest[at])
                np.add.at(total, of, times * counts[at])
                rows.append((chunk, radix, _packed(best, total)))
        return pd.DataFrame(rows, columns=["chunk", "radix", "body"])

    copies = merged.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    own = _salted(runs.select("chunk", "radix", "head", "body", "rows"), groups).groupBy("radix", "salt")
    return own.cogroup(copies.groupBy("radix", "salt")).applyInPandas(give, "chunk long, radix int, body binary")


def align_tokens(
    docs: DataFrame, byte_level_path: str, pieces_path: str, id_column: str = "doc_id", text_column: str = "text",
    radix: int = RADIX, fan_in: int = FAN_IN, chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """One row per document row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A encodes a space and the text by a byte-level BPE file, B the text by a
    sentence-piece model that adds the space, both without special tokens, whose strings in a text are
    plain text.  Where an A and a B token end at one byte a group ends.  An A and a B
    token are linked if their bytes overlap; the count of an id pair is the number of
    document rows that hold it linked.  n_best counts the links whose count is the
    highest of their A id, ties included; count_sum adds the counts of all links.
    groups_sha256 is of ``a1,a2|b1;a3|b2,b3``.  A null or empty text, and one whose token bytes are not the
    space and the text on both sides, has zeros and the empty digest.  Rows with one doc_id are documents of their
    own, also where they are equal; other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    names = ship_file(spark, byte_level_path), ship_file(spark, pieces_path)
    size_b = sentencepiece.SentencePieceProcessor(model_file=pieces_path).vocab_size()
    chunks = _chunks(docs, *names, radix, chunk_bytes, id_column, text_column)
    own, runs = chunks.where("radix = -1"), chunks.where("radix >= 0")
    count = own.count()
    parts = own.select("chunk", "radix", "body", "doc_id", *_FACTS, "groups_sha256")
    if count:
        merged = _merged(runs, count, fan_in)
        given = _contributions(runs, merged, -(-count // fan_in), size_b)
        parts = parts.unionByName(given, allowMissingColumns=True)

    def collect(group: pd.DataFrame) -> pd.DataFrame:
        """A chunk's documents; one row for each radix at most is added up."""
        first = group[group["radix"] == -1].iloc[0]
        best, total = np.zeros((2, len(first["doc_id"])), np.int64)
        for body in group["body"][group["radix"] >= 0]:
            one, two = _unpacked(body)
            best, total = best + one, total + two
        ids = pd.array([None if pd.isna(i) else int(i) for i in first["doc_id"]], "Int64")
        return pd.DataFrame(
            {"doc_id": ids} | {c: first[c] for c in _FACTS} | {"n_best": best, "count_sum": total, "groups_sha256": first["groups_sha256"]}
        )

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in _FACTS) + ", n_best long, count_sum long, groups_sha256 string"
    return parts.groupBy("chunk").applyInPandas(collect, schema)
