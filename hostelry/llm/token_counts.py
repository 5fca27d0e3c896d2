"""Token counts by rank-synchronous merging of batched words."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import whole_text
from .vocabulary import Vocabulary, merge_words, vocabulary

LIMIT = 512
KNOWN_WORDS = 500_000  # words a process remembers; when reached it starts over


def count_symbols(words: list[str], vocab: Vocabulary) -> np.ndarray:
    """Surviving symbols of each word."""
    _, owner = merge_words([w.encode("utf-8") for w in words], vocab)
    return np.bincount(owner, minlength=len(words))


class Counter:
    """Counts the tokens of texts; only words not met before are merged, in one batch."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.known: dict[str, int] = dict.fromkeys(vocab.special, 1)

    def counts(self, texts: list[str]) -> list[int]:
        if len(self.known) > KNOWN_WORDS:
            self.known = dict.fromkeys(self.vocab.special, 1)
        split = [self.vocab.words(t) for t in texts]
        new: set[str] = set()
        for words in split:
            new.update(words)
        fresh = [w for w in new if w not in self.known]
        self.known.update(zip(fresh, count_symbols(fresh, self.vocab).tolist()))
        return [sum(map(self.known.__getitem__, words)) for words in split]


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One per process, so that tasks of one worker share the words they know."""
    return Counter(vocabulary(path))


def token_counts(
    docs: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text_column: str = "text", limit: int = LIMIT,
) -> DataFrame:
    """One row per document row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Counts are those of the vocabulary's own library without added tokens; a special
    token written in a text is one token.  Null is the empty text with no token.
    Other columns are not read, an empty table gives no rows, and rows with one
    doc_id are counted each.  No shuffle.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = counter(vocabulary_path)
        for batch in batches:
            n = np.array(known.counts(batch["text"].tolist()), np.int64)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_bytes": batch["n_bytes"], "n_tokens": n, "over_limit": n > limit})

    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.octet_length(whole_text(text_column)).cast("long").alias("n_bytes"),
        whole_text(text_column).alias("text"),
    )
    return rows.mapInPandas(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
