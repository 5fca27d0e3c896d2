"""BPE encoding and decoding by speculation and verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import whole_text
from .vocabulary import NO_MERGE, Vocabulary, merge_words, vocabulary

KNOWN_WORDS = 500_000  # words a process remembers; when reached it starts over


class Speculator:
    """Encodes words: longest-match guess, check of all adjacent pairs, exact merging of the rest."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        # The longest token that starts with two given bytes.
        self.longest: dict[bytes, int] = {}
        for token in vocab.id_of:
            head = token[:2]
            self.longest[head] = max(self.longest.get(head, 1), len(token))

    @cached_property
    def sound(self) -> np.ndarray:
        """Tokens that merging their own bytes gives back; no other token ever comes out of merging."""
        tokens = list(self.vocab.id_of.items())
        symbols, owner = merge_words([b for b, _ in tokens], self.vocab)
        single = np.bincount(owner, minlength=len(tokens)) == 1
        ids = np.array([i for _, i in tokens])
        out = np.zeros(self.vocab.size, bool)
        out[ids[single]] = symbols[single[owner]] == ids[single]
        return out

    def guess(self, word: bytes) -> list[int]:
        """Greedy longest match from the left."""
        ids, at, end = [], 0, len(word)
        id_of, longest = self.vocab.id_of, self.longest
        while at < end:
            size = min(longest.get(word[at : at + 2], 1), end - at)
            while size > 1 and word[at : at + size] not in id_of:
                size -= 1
            ids.append(id_of[word[at : at + size]])
            at += size
        return ids

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the bytes of a and b together leaves exactly the two tokens.

        Merging is run backwards for all pairs at once.  x is the symbol at the right
        edge of a, y at the left edge of b, until the merges x_until and y_until take
        them.  The pair fails if x and y could merge before either is taken; of two
        merges of one rank the left one is first.  Then the later-made of x and y is
        undone.
        """
        v = self.vocab
        x, y = a.copy(), b.copy()
        x_until, y_until = (np.full(len(a), NO_MERGE) for _ in range(2))
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            rank = v.pair_rank(x[live], y[live])
            clash = (rank != NO_MERGE) & (rank < x_until[live]) & (rank <= y_until[live])
            good[live[clash]] = False
            made_x, made_y = v.rank_of[x[live]], v.rank_of[y[live]]
            more = ~clash & ((made_x >= 0) | (made_y >= 0))
            undo_x = live[more & (made_x > made_y)]
            undo_y = live[more & (made_x <= made_y)]
            x_until[undo_x], x[undo_x] = v.rank_of[x[undo_x]], v.right_of[x[undo_x]]
            y_until[undo_y], y[undo_y] = v.rank_of[y[undo_y]], v.left_of[y[undo_y]]
            live = live[more]
        return good

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each non-empty word as little-endian unsigned 32-bit integers."""
        guesses = [self.guess(w) for w in words]
        sizes = np.array([len(g) for g in guesses], np.int64)
        flat = np.array([i for g in guesses for i in g], np.int64)
        owner = np.repeat(np.arange(len(words)), sizes)
        fails = np.zeros(len(words), bool)
        fails[owner[~self.sound[flat]]] = True
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, where = np.unique(flat[inner] * self.vocab.size + flat[inner + 1], return_inverse=True)
        good = self.compatible(pairs // self.vocab.size, pairs % self.vocab.size)
        fails[owner[inner[~good[where]]]] = True
        out = [np.array(g, "<u4").tobytes() for g in guesses]
        failing = np.flatnonzero(fails)
        symbols, word = merge_words([words[i] for i in failing], self.vocab)
        ends = np.searchsorted(word, np.arange(1, len(failing) + 1))
        for i, start, end in zip(failing, np.r_[0, ends[:-1]], ends):
            out[i] = symbols[start:end].astype("<u4").tobytes()
        return out


class Codec:
    """Encodes and decodes texts; only words not met before are encoded, in one batch."""

    def __init__(self, vocab: Vocabulary):
        self.words_of = vocab.words
        self.speculator = Speculator(vocab)
        self.special = {t: np.array([i], "<u4").tobytes() for t, i in vocab.special.items()}
        self.known = dict(self.special)
        self.token_bytes = [vocab.bytes_of.get(i, b"") for i in range(vocab.size)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        if len(self.known) > KNOWN_WORDS:
            self.known = dict(self.special)
        split = [self.words_of(t) for t in texts]
        new: set[str] = set()
        for words in split:
            new.update(words)
        fresh = [w for w in new if w not in self.known]
        self.known.update(zip(fresh, self.speculator.encode([w.encode("utf-8") for w in fresh])))
        return [b"".join(map(self.known.__getitem__, words)) for words in split]

    def decode(self, ids: bytes) -> str:
        """The text of the ids, special tokens included; broken UTF-8 becomes U+FFFD."""
        pieces = map(self.token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())
        return b"".join(pieces).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def codec_of(path: str) -> Codec:
    """One per process, so that tasks of one worker share the words they know."""
    return Codec(vocabulary(path))


def encode_documents(docs: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document row: doc_id and ``ids``, little-endian unsigned 32-bit integers.

    The ids are those of the vocabulary's own library without added tokens; a special
    token written in a text is its id.  Null is the empty text without ids.  Other
    columns are not read; an empty table gives no rows.  No shuffle.
    """

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = codec_of(vocabulary_path)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "ids": codec.encode(batch["text"].tolist())})

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
    return rows.mapInPandas(encode, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id and text of rows of ``encode_documents``; null ids give the empty text."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = codec_of(vocabulary_path)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text": [codec.decode(x or b"") for x in batch["ids"]]})

    return encoded.select("doc_id", "ids").mapInPandas(decode, "doc_id long, text string")


def codec_digests(docs: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row: encoded, then decoded from the ids."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = codec_of(vocabulary_path)
        for batch in batches:
            ids = codec.encode(batch["text"].tolist())
            yield pd.DataFrame({
                "doc_id": batch["doc_id"],
                "n_tokens": np.array([len(x) // 4 for x in ids], np.int64),
                "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                "decoded_sha256": [hashlib.sha256(codec.decode(x).encode("utf-8")).hexdigest() for x in ids],
            })

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
    return rows.mapInPandas(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
