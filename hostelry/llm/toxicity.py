"""Toxicity scores by a counterfactually regularised logistic classifier."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import fold, free_name, stored, whole_text

TRAINING_ROWS = 4000  # labelled rows of each class that are fitted, at most about
FEATURES = 4096  # words and word beginnings with a weight, at most
MIN_ROWS = 3  # training rows in which a feature must occur
MIN_CHI2 = 15.0  # association with the label below which a feature is taken for chance
SWAP_WEIGHT = 10.0
RIDGE = 1e-4
STEPS = 300
FOLDS, HELD_OUT = 5, 0
KNOWN_WORDS = 200_000  # words a task remembers; when reached it starts over
PREFIXES = (4, 5, 6)

# Terms for groups of people; a term is swapped for the next one of its row.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"), ("immigrants", "natives", "refugees"),
    ("blind", "deaf", "disabled"), ("old", "young"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("immigrés", "réfugiés"), ("homosexuels", "hétérosexuels"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("ausländer", "flüchtlinge"), ("schwule", "lesben"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("inmigrantes", "refugiados"), ("homosexuales", "heterosexuales"),
)
_SWAP = {t: row[(i + 1) % len(row)] for row in IDENTITY_TERMS for i, t in enumerate(row)}
_WORD = re.compile(r"\w+")


def _words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def _features_of(word: str) -> list[str]:
    """The word, and its beginnings (marked by a dash): inflected and compounded words share those."""
    return [word, *[f"{word[:k]}-" for k in PREFIXES if len(word) >= k]]


def _features(words: set[str]) -> set[str]:
    return {f for w in words for f in _features_of(w)}


@dataclass
class Model:
    """log-odds = bias + the weights of the features present in the whole text."""

    bias: float
    weights: dict[str, float] = field(default_factory=dict)

    def score(self, texts: list[str], known: dict[str, tuple[str, ...]]) -> np.ndarray:
        """Scores from 0 to 1; ``known`` keeps the weighted features of words met before."""
        if len(known) > KNOWN_WORDS:
            known.clear()
        odds = np.empty(len(texts))
        for i, text in enumerate(texts):
            present: set[str] = set()
            for word in _words(text):
                found = known.get(word)
                if found is None:
                    found = known[word] = tuple(f for f in _features_of(word) if f in self.weights)
                present.update(found)
            odds[i] = self.bias + sum(map(self.weights.__getitem__, sorted(present)))
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def _labelled(labels: DataFrame, id_column: str) -> DataFrame:
    """labelled, toxic: one row per id outside the held-out fold; toxic if any of its labels says so."""
    told = labels.select(F.col(id_column).cast("long").alias("labelled"), F.col("toxic").cast("int").alias("toxic"))
    told = told.where("labelled IS NOT NULL AND toxic IN (0, 1)").groupBy("labelled").agg(F.max("toxic").alias("toxic"))
    return stored(told.where(fold("labelled", FOLDS) != HELD_OUT), "labels")


def _sample(docs: DataFrame, told: DataFrame, id_column: str, text_column: str, per_class: int) -> DataFrame:
    """label, words features and swapped features of at most ``per_class`` rows of each class.

    Which rows is decided by a hash of the id, with the share of each class set by its
    count, so that the sample spreads over all rows.  Rows that repeat an id and a text
    are one; of more rows than the bound those of lowest hash stay.  So ids and keys
    are few, however often rows are repeated, and can be broadcast.
    """
    sizes = dict(tuple(r) for r in told.groupBy("toxic").count().collect())
    share = F.lit(0.0)
    for value, size in sizes.items():
        share = F.when(F.col("toxic") == value, min(1.0, per_class / size)).otherwise(share)
    chosen = told.where(F.pmod(F.xxhash64("labelled"), F.lit(1 << 30)) < share * float(1 << 30))
    text = whole_text(text_column)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    keys = rows.join(F.broadcast(chosen), F.col("id") == F.col("labelled")).select("toxic", "id", "text_key").distinct()
    order = F.xxhash64("id", "text_key")
    bounded = [keys.where(F.col("toxic") == value).orderBy(order, "id", "text_key").limit(per_class) for value in (0, 1)]
    few = stored(bounded[0].union(bounded[1]).withColumnsRenamed({"id": "few_id", "text_key": "few_key"}), "keys")
    named = (F.col("id") == F.col("few_id")) & (F.col("text_key") == F.col("few_key"))
    picked = rows.join(F.broadcast(few), named).dropDuplicates(["id", "text_key"]).select("toxic", "text")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own, swapped = [], []
            for text in batch.text:
                words = _words(text)
                own.append(sorted(_features(words)))
                named = words & _SWAP.keys()
                swapped.append(sorted(_features(words - named | {_SWAP[w] for w in named})) if named else None)
            yield pd.DataFrame({"toxic": batch.toxic, "own": own, "swapped": swapped})

    return stored(picked.mapInPandas(read, "toxic int, own array<string>, swapped array<string>"), "sample")


def _chosen_features(sample: DataFrame, count: int) -> list[str]:
    """The features most associated with the label, at most ``count``."""
    totals = sample.agg(F.count("*"), F.sum("toxic")).first()
    n, positive = float(totals[0]), float(totals[1] or 0)
    each = sample.select("toxic", F.explode("own").alias("feature")).groupBy("feature").agg(
        F.count("*").cast("double").alias("rows"), F.sum("toxic").cast("double").alias("hits")
    )
    expected = F.col("rows") * positive / n if n else F.lit(0.0)
    spread = F.col("rows") * (positive / n) * (1 - positive / n) * (n - F.col("rows")) / (n - 1) if n > 1 else F.lit(1.0)
    scored = each.where(F.col("rows") >= MIN_ROWS).withColumn("chi2", F.pow(F.col("hits") - expected, 2) / F.greatest(spread, F.lit(1e-9)))
    best = scored.where(F.col("chi2") >= MIN_CHI2).orderBy(F.desc("chi2"), "feature").limit(count)
    return [r["feature"] for r in best.select("feature").collect()]


def _rows_of(sets: list, width: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(s) for s in sets]
    return np.repeat(np.arange(len(sets)), sizes), np.array([c for s in sets for c in s], np.int64)


def _minimise(slope_of, x: np.ndarray, steps: int) -> np.ndarray:
    """Limited-memory quasi-Newton descent; slope_of gives value and gradient."""
    value, slope = slope_of(x)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        way, factors = slope.copy(), []
        for move, bend in reversed(moves):
            factors.append((move @ way) / (move @ bend))
            way -= factors[-1] * bend
        if moves:
            move, bend = moves[-1]
            way *= (move @ bend) / (bend @ bend)
        for (move, bend), factor in zip(moves, reversed(factors)):
            way += (factor - (bend @ way) / (move @ bend)) * move
        step, descent = 1.0, slope @ way
        while True:
            x_new = x - step * way
            value_new, slope_new = slope_of(x_new)
            if value_new <= value - 1e-4 * step * descent or step < 1e-8:
                break
            step /= 2
        move, bend = x_new - x, slope_new - slope
        settled = value - value_new <= 1e-10 * max(1.0, abs(value))
        x, value, slope = x_new, value_new, slope_new
        if settled:
            break
        if move @ bend > 1e-12:
            moves = [*moves[-9:], (move, bend)]
    return x


def fit(own: list[list[int]], swapped: list[list[int] | None], toxic: np.ndarray, width: int, swap_weight: float) -> tuple[float, np.ndarray]:
    """Bias and weights that minimise

    mean log-loss with both classes weighing the same + RIDGE |w|^2
    + swap_weight * mean (w . (swapped features - own features))^2 over rows with a swap.
    """
    at, feature = _rows_of(own, width)
    pairs = [(a, b) for a, b in zip(own, swapped) if b is not None]
    pair_at, pair_feature = _rows_of([a + b for a, b in pairs], width)
    sign = np.concatenate([np.r_[-np.ones(len(a)), np.ones(len(b))] for a, b in pairs] + [np.empty(0)])
    weight = np.where(toxic == 1, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (1 - toxic).sum()))

    def slope_of(x: np.ndarray) -> tuple[float, np.ndarray]:
        bias, w = x[0], x[1:]
        odds = bias + np.bincount(at, w[feature], minlength=len(own))
        loss = weight @ (np.logaddexp(0, odds) - toxic * odds) + RIDGE * (w @ w)
        error = weight * (1 / (1 + np.exp(-np.clip(odds, -700, 700))) - toxic)
        slope = np.bincount(feature, error[at], minlength=width) + 2 * RIDGE * w
        if pairs:
            change = np.bincount(pair_at, sign * w[pair_feature], minlength=len(pairs))
            loss += swap_weight * (change @ change) / len(pairs)
            slope += 2 * swap_weight / len(pairs) * np.bincount(pair_feature, sign * change[pair_at], minlength=width)
        return loss, np.r_[error.sum(), slope]

    x = _minimise(slope_of, np.zeros(width + 1), STEPS)
    return float(x[0]), x[1:]


def train(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    per_class: int = TRAINING_ROWS, features: int = FEATURES, swap_weight: float = SWAP_WEIGHT,
) -> Model:
    """A model of labels.toxic from rows outside the held-out fold.

    Fitted on a sample of at most ``per_class`` rows of each class.  Null ids and labels
    are left out; a doc_id labelled twice is toxic if either label says so.  The fit
    gives both classes the same weight; a text without any weighted feature, about
    which the model knows nothing, gets the share of toxic labels at most.  So where no
    feature is chosen, as in a table of few rows, every score is that share.  Without
    labels every score is 0; with one class only, every score is that class.
    """
    told = _labelled(labels, id_column)
    counts = dict(tuple(r) for r in told.groupBy("toxic").count().collect())
    sample = _sample(docs, told, id_column, text_column, per_class)
    chosen = _chosen_features(sample, features)
    index = {f: i for i, f in enumerate(chosen)}

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pick = lambda s: None if s is None else [index[f] for f in s if f in index]
            yield pd.DataFrame({"toxic": batch.toxic, "own": batch.own.map(pick), "swapped": batch.swapped.map(pick)})

    rows = sample.mapInPandas(match, "toxic int, own array<int>, swapped array<int>").collect()
    toxic = np.array([r["toxic"] for r in rows], np.int64)
    if not len(rows) or toxic.min() == toxic.max():
        return Model(40.0 if len(rows) and toxic[0] else -40.0)
    bias, weights = fit([list(r["own"]) for r in rows], [r["swapped"] and list(r["swapped"]) for r in rows], toxic, len(chosen), swap_weight)
    return Model(min(bias, math.log(counts[1] / counts[0])), dict(zip(chosen, weights.tolist())))


def score_column(model: Model, text_column: str = "text") -> Column:
    """The score of the whole text, null as the empty text."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, tuple[str, ...]] = {}
        for texts in batches:
            yield pd.Series(model.score(texts.tolist(), known))

    return score(whole_text(text_column))


def toxicity(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    per_class: int = TRAINING_ROWS, features: int = FEATURES, swap_weight: float = SWAP_WEIGHT,
) -> DataFrame:
    """One row per document row: doc_id, held_out, score (0 to 1), predicted (score >= 0.5).

    Scores depend on the text alone, null as the empty text.  Rows with one doc_id are
    scored each; an empty table gives no rows; other columns are not read.  Small tables
    and missing labels: see ``train``.
    """
    model = train(docs, labels, id_column, text_column, per_class, features, swap_weight)
    scored = docs.select(
        F.col(id_column).alias("doc_id"), (fold(id_column, FOLDS) == HELD_OUT).alias("held_out"), score_column(model, text_column).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without the rows predicted toxic, all columns as they were.

    Null texts are scored as empty ones; repeated rows stay or go together.  Without
    labels, or with too few rows for any feature, all rows stay, unless toxic labels are in the
    majority; an empty table stays empty.
    """
    model = train(docs, labels, id_column, text_column)
    name = free_name(docs, "_score")
    return docs.withColumn(name, score_column(model, text_column)).where(F.col(name) < 0.5).drop(name)
