"""Language identification by a string kernel, Nyström landmarks and ridge regression."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import fold, stored, whole_text

ORDERS = (1, 2, 3)  # lengths of the n-grams of the blended spectrum
BINS = 1 << 15  # n-grams are hashed into so many presence flags
TRAINING_ROWS = 4000  # training rows of all languages together, at most about
SEGMENT = 1024  # code points of the parts in which a text is read, at most
MIN_SHARE = 0.002  # share of the rows that a language needs to be learned
DRAWS = 1 << 62
LANDMARKS = 160  # of those, the rows that span the model
RIDGE = 1e-4
FOLDS, HELD_OUT = 4, 2
MINI_BATCH = 64
UNKNOWN = "und"


def segments(text: str) -> list[np.ndarray]:
    """The code points of the whole lower-cased text in equal parts."""
    points = np.frombuffer(text.lower().encode("utf-32-le", errors="surrogatepass"), "<u4")
    return np.array_split(points, max(1, -(-len(points) // SEGMENT)))


def presence(points: np.ndarray) -> np.ndarray:
    """Which hashed n-grams the code points hold."""
    flags = np.zeros(BINS, bool)
    rolled = np.zeros(len(points), np.uint32)
    with np.errstate(over="ignore"):
        for order in range(1, max(ORDERS) + 1):
            if len(points) < order:
                break
            rolled = rolled[: len(points) - order + 1] * np.uint32(0x01000193) + points[order - 1 :] + np.uint32(1)
            if order in ORDERS:
                mixed = (rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * order)
                flags[(mixed ^ (mixed >> np.uint32(13))) & np.uint32(BINS - 1)] = True
    return flags


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Shared n-grams of each pair of rows, over the geometric mean of their numbers; 1 for equal sets."""
    bins = b.any(axis=0)
    base = b[:, bins].astype(np.float32).T
    parts = [a[k : k + 256] for k in range(0, len(a), 256)]
    shared = np.concatenate([part[:, bins].astype(np.float32) @ base for part in parts])
    return shared / np.sqrt(np.outer(np.maximum(1, a.sum(axis=1)), np.maximum(1, b.sum(axis=1))))


@dataclass
class Model:
    """Scores are kernel values with the landmarks times a weight per language."""

    languages: list[str]
    bins: np.ndarray  # flags that any landmark has
    landmarks: np.ndarray  # float32, landmarks by those bins
    sizes: np.ndarray
    weights: np.ndarray

    def values(self, flags: np.ndarray) -> np.ndarray:
        shared = flags[:, self.bins].astype(np.float32) @ self.landmarks.T
        return (shared / np.sqrt(np.outer(np.maximum(1, flags.sum(axis=1)), self.sizes))) @ self.weights

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The language of the highest mean value over the parts of each text, and that value."""
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        totals, counts = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        waiting: list[tuple[int, np.ndarray]] = []

        def score() -> None:
            owners = [i for i, _ in waiting]
            np.add.at(totals, owners, self.values(np.stack([f for _, f in waiting])))
            np.add.at(counts, owners, 1)
            waiting.clear()

        for i, text in enumerate(texts):
            for points in segments(text) if self.languages and has_letter(text) else []:
                waiting.append((i, presence(points)))
                if len(waiting) == MINI_BATCH:
                    score()
        if waiting:
            score()
        for i in np.flatnonzero(counts):
            best = int(totals[i].argmax())
            names[i], scores[i] = self.languages[best], min(1.0, max(0.0, float(totals[i, best] / counts[i])))
        return names, scores


def fit(flags: np.ndarray, names: list[str], landmarks: int, ridge: float) -> Model:
    """One-versus-rest kernel ridge regression on the landmarks' span.

    The landmarks are the first rows of each language, in equal numbers as far as they
    go.  With K the kernel of rows and landmarks and M that of the landmarks, the
    weights solve (K'K + ridge n M) w = K'y for the 0/1 targets of each language.
    """
    languages = sorted(set(names))
    by_language = [[i for i, x in enumerate(names) if x == language] for language in languages]
    chosen = sorted(i for rows in by_language for i in rows[: max(1, landmarks // len(languages))])
    base = flags[chosen]
    wide, among = kernel(flags, base).astype(np.float64), kernel(base, base).astype(np.float64)
    targets = np.array([[x == language for language in languages] for x in names], np.float64)
    system = wide.T @ wide + ridge * len(names) * among + 1e-9 * len(names) * np.eye(len(chosen))
    weights = np.linalg.solve(system, wide.T @ targets)
    bins = base.any(axis=0)
    return Model(languages, bins, base[:, bins].astype(np.float32), np.maximum(1, base.sum(axis=1)), weights)


def train(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
    rows: int = TRAINING_ROWS, landmarks: int = LANDMARKS, ridge: float = RIDGE, min_share: float = MIN_SHARE,
) -> Model:
    """A model from rows outside the held-out fold with a language and a letter in the text.

    Fitted on a sample of at most about ``rows`` rows, the same number of each language as far
    as they go, with one part of each text.  Languages with less than ``min_share`` of the
    rows are not learned, so there are at most 1 / min_share.  Rows and parts are taken by a hash, so the
    sample spreads over the table and the texts; rows that repeat an id and a text are
    one.  What comes to the driver is a bit per n-gram bin and row.
    """
    text = whole_text(text_column)
    usable = docs.select(
        F.col(id_column).cast("long").alias("id"), F.col(lang_column).alias("lang"), text.alias("text"),
        F.pmod(F.xxhash64(F.col(id_column).cast("long"), text), F.lit(DRAWS)).alias("draw"),
    ).where(F.col("lang").isNotNull() & (fold("id", FOLDS) != HELD_OUT))
    counts = stored(usable.groupBy("lang").count(), "languages")
    total = counts.agg(F.sum("count")).first()[0] or 0
    frequent = counts.where(F.col("count") >= min_share * total)
    each = max(1, math.ceil(rows / max(1, frequent.count())))
    shares = frequent.select(F.col("lang").alias("known"), (float(each) / F.col("count") * float(DRAWS)).alias("below"))
    drawn = usable.join(F.broadcast(shares), F.col("lang") == F.col("known")).where(F.col("draw") < F.col("below"))
    # Of one language no more than its number, by the draw; equal rows are one.
    ranked = drawn.select("lang", "draw").distinct().withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("draw")))
    keys = stored(ranked.where(F.col("rank") <= each).select(F.col("lang").alias("key_lang"), F.col("draw").alias("key_draw")), "keys")
    chosen = (F.col("lang") == F.col("key_lang")) & (F.col("draw") == F.col("key_draw"))
    picked = usable.join(F.broadcast(keys), chosen).dropDuplicates(["lang", "draw"]).select("id", "lang", "text", "draw")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[[has_letter(t) for t in batch.text]]
            parts = [segments(t) for t in batch.text]
            flags = [np.packbits(presence(p[d % len(p)])).tobytes() for p, d in zip(parts, batch.draw)]
            yield pd.DataFrame({"draw": batch.draw, "lang": batch.lang, "flags": flags})

    sample = stored(picked.mapInPandas(read, "draw long, lang string, flags binary"), "sample").orderBy("draw", "lang", "flags").collect()
    if not sample:
        return Model([], np.zeros(BINS, bool), np.zeros((0, 0), np.float32), np.zeros(0), np.zeros((0, 0)))
    names = [r["lang"] for r in sample]
    packed = np.frombuffer(b"".join(bytes(r["flags"]) for r in sample), np.uint8).reshape(len(sample), -1)
    return fit(np.unpackbits(packed, axis=1).view(bool), names, landmarks, ridge)


def language_id(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
    rows: int = TRAINING_ROWS, landmarks: int = LANDMARKS, ridge: float = RIDGE,
) -> DataFrame:
    """One row per document row: doc_id, held_out, lang_pred, score (0 to 1).

    Predictions depend on the whole text alone, read in parts of bounded length whose
    values are averaged, so a quotation in another language counts by its length.  A
    text without a letter, null included, is ``und`` with score 0, as is every text
    where no language can be learned.  Rows with one doc_id are predicted each; an
    empty table gives no rows; other columns are not read.
    """
    model = train(docs, id_column, text_column, lang_column, rows, landmarks, ridge)

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names, scores = model.predict(batch.text.tolist())
            yield pd.DataFrame({"doc_id": batch.doc_id, "held_out": batch.held_out, "lang_pred": names, "score": scores})

    source = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), (fold(id_column, FOLDS) == HELD_OUT).alias("held_out"), whole_text(text_column).alias("text")
    )
    return source.mapInPandas(predict, "doc_id long, held_out boolean, lang_pred string, score double")
