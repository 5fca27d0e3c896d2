"""A byte-level BPE vocabulary file as numpy tables, and splitting texts into its words."""

from __future__ import annotations

import json
import re
from functools import cached_property, lru_cache

import numpy as np
import regex
from tokenizers import Tokenizer

# The word pattern of byte-level BPE, as published with its vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# White space as Unicode defines it, without the separators U+001C to U+001F.
_WORD = regex.compile(PATTERN.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))

# Libraries differ in their Unicode version on other code points, most of them unassigned.
# Texts with one of those are cut by the tokenizer library itself.
OTHER_CODE_POINTS = re.compile("[^\x00-\u052F\u2000-\u2070\u2100-\uA7CD\uAC00-\uD7A3\U0001F300-\U0001F6FF]")

NO_MERGE = np.iinfo(np.int64).max


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file.

    Printable bytes stand for themselves; the others are numbered from code point 256.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Ids, merges and special tokens of one file, as arrays.

    Raises ValueError for files with a normaliser, another way of splitting, or special
    tokens that also take neighbouring blanks: their texts would be split differently.
    """

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec["pre_tokenizer"]
        odd = [t for t in spec["added_tokens"] if t["lstrip"] or t["rstrip"] or t["single_word"]]
        if spec["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or odd:
            raise ValueError(f"not a plain byte-level vocabulary: {path}")
        letters = _byte_letters()
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {
            i: t.encode() if t in self.special else bytes(letters[c] for c in t) for t, i in ids.items()
        } | {i: t.encode() for t, i in self.special.items()}
        self.id_of = {b: i for i, b in self.bytes_of.items() if i not in self.special.values()}
        self.size = max(self.bytes_of) + 1
        self.byte_ids = np.array([self.id_of[bytes([b])] for b in range(256)], np.int64)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        left = np.array([ids[a] for a, _ in merges], np.int64)
        right = np.array([ids[b] for _, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        rank = np.arange(len(merges), dtype=np.int64)
        # Per token the merge that makes it; -1 for single bytes.
        self.rank_of, self.left_of, self.right_of = (np.full(self.size, -1, np.int64) for _ in range(3))
        first = rank[::-1]  # where two merges make one token the earlier one holds
        self.rank_of[made[first]], self.left_of[made[first]], self.right_of[made[first]] = first, left[first], right[first]
        keys = left * self.size + right
        order = np.argsort(keys)
        self._keys, self._ranks = keys[order], rank[order]
        self.made_by = made
        marks = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self._special = regex.compile(f"({'|'.join(marks)})") if marks else None

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair, NO_MERGE where there is none."""
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._ranks[at], NO_MERGE)

    def words(self, text: str) -> list[str]:
        """The text cut into special tokens and words; joined they are the text."""
        cut = self._cut_by_library if OTHER_CODE_POINTS.search(text) else _WORD.findall
        if self._special is None or not self._special.search(text):
            return cut(text)
        out: list[str] = []
        for i, part in enumerate(self._special.split(text)):
            out += [part] if i % 2 else cut(part)
        return out

    @cached_property
    def library(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    def _cut_by_library(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One copy per process."""
    return Vocabulary(path)


def ragged(words: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All symbols of the words one after another, and the index of the word of each."""
    symbols = vocab.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    return symbols, np.repeat(np.arange(len(words)), [len(w) for w in words])


def merge_words(words: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The final symbols of non-empty words and the index of the word of each, in order of words.

    Rank-synchronous: in every round each word's lowest-rank pair is merged at all its
    places at once.  That is the sequential result, as a symbol made by a merge only
    takes part in merges of higher rank.  Words without a mergeable pair leave the arrays.
    """
    symbols, owner = ragged(words, vocab)
    finished = []
    while len(symbols):
        rank = np.full(len(symbols), NO_MERGE)
        rank[:-1] = vocab.pair_rank(symbols[:-1], symbols[1:])
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        rank[np.r_[starts[1:] - 1, len(symbols) - 1]] = NO_MERGE  # pairs across words
        lengths = np.diff(np.r_[starts, len(symbols)])
        lowest = np.repeat(np.minimum.reduceat(rank, starts), lengths)
        active = lowest != NO_MERGE
        if not active.all():
            finished.append((symbols[~active], owner[~active]))
            symbols, owner, rank, lowest = symbols[active], owner[active], rank[active], lowest[active]
            if not len(symbols):
                break
        hit = rank == lowest
        # In a run such as "aaa" neighbouring hits overlap: every other one counts, from the left.
        place = np.arange(len(hit))
        run_start = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], place, 0))
        hit &= (place - run_start) % 2 == 0
        symbols[hit] = vocab.made_by[rank[hit]]
        stay = ~np.r_[False, hit[:-1]]
        symbols, owner = symbols[stay], owner[stay]
    if not finished:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    symbols, owner = (np.concatenate(x) for x in zip(*finished))
    order = np.argsort(owner, kind="stable")
    return symbols[order], owner[order]
