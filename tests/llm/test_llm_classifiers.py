"""Toxicity and language identification: held-out accuracy, folds, odd rows."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from hostelry.llm import language_id, toxicity

DOCS = "doc_id long, text string, lang string, score string, held_out int, toxic int, predicted string"
LABELS = "doc_id long, quality int, toxic int, text string"


def _corpus(n, seed=1):
    rng = random.Random(seed)
    plain = [f"wort{chr(97 + i % 26)}{i % 7}" for i in range(200)]
    bad = ["dreck", "murks", "schund"]
    out = []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 60))]
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", "haft", "ig", "x" + str(i)]))
        out.append((i, " ".join(words), int(toxic)))
    return out


def _copies(docs, count):
    return docs.withColumn("copy", F.explode(F.array_repeat(F.lit(1), count))).drop("copy")


def _frames(rows, corpus):
    docs = rows(DOCS, *[(i, t, None, "s", 1, 2, "p") for i, t, _ in corpus])
    return docs, rows(LABELS, *[(i, 1, y, "t") for i, _, y in corpus])


def test_toxicity_on_held_out_rows(rows):
    corpus = _corpus(600)
    found = {r["doc_id"]: r for r in toxicity.toxicity(*_frames(rows, corpus)).collect()}
    held = [(found[i]["predicted"], y) for i, _, y in corpus if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 80 and np.mean([a == b for a, b in held]) > 0.97
    for i, _, _ in corpus:
        assert found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= found[i]["score"] <= 1 and found[i]["predicted"] == int(found[i]["score"] >= 0.5)


def test_held_out_labels_do_not_matter(rows):
    corpus = _corpus(300, seed=2)
    turned = [(i, t, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, t, y in corpus]
    a, b = (sorted((r["doc_id"], r["score"]) for r in toxicity.toxicity(*_frames(rows, c)).collect()) for c in (corpus, turned))
    assert a == b


def test_swapping_lowers_the_weight_of_identity_terms(rows):
    """A group's name that comes with insults in training is not an insult by itself."""
    rng = random.Random(3)
    corpus = []
    for i, text, y in _corpus(800, seed=3):
        if y and i % 2:  # only the group's name tells this one from a clean text
            text = " ".join(w for w in text.split() if w.startswith("wort")) + " muslim"
        elif y and rng.random() < 0.5 or rng.random() < 0.02:
            text += " muslim"
        corpus.append((i, text, y))
    docs, labels = _frames(rows, corpus)
    neutral, insult = ["worta0 wortb1 muslim wortc2", "muslim"], ["wortd3 murks worte4 muslim", "schund"]
    plain, swapped = (toxicity.train(docs, labels, swap_weight=w) for w in (0.0, 10.0))
    assert (plain.score(neutral, {}) > 0.5).all() and (plain.score(insult, {}) > 0.5).all()
    assert (swapped.score(neutral, {}) < 0.5).all() and (swapped.score(insult, {}) > 0.5).all()
    assert (swapped.score(["muslim", "hindu", "atheist"], {}).round(1) == swapped.score(["christian"], {}).round(1)).all()


def test_toxicity_of_odd_rows(spark, rows):
    corpus = _corpus(200, seed=4)
    _, labels = _frames(rows, corpus)
    odd = rows(DOCS, *[(i, t, None, "s", 1, 2, "p") for i, t, _ in corpus], (None, None, None, "s", 1, 2, "p"), (5, "", None, "s", 1, 2, "p"), (5, "dreck " * 50_000, None, "s", 1, 2, "p"))
    extra = rows(LABELS, (None, 1, 1, "t"), (3, 1, None, "t"), (999, 1, 1, "t"), (5, 1, 1, "t"))
    found = toxicity.toxicity(odd, labels.union(extra)).collect()
    assert len(found) == 203 and all(0 <= r["score"] <= 1 for r in found)
    assert toxicity.toxicity(odd.limit(0), labels).collect() == []
    assert {r["score"] < 1e-9 for r in toxicity.toxicity(odd, labels.limit(0)).collect()} == {True}
    kept = toxicity.drop_toxic(odd, labels.union(extra))
    assert kept.columns == odd.columns and 100 < kept.count() < 203


def test_small_tables_keep_their_rows(rows):
    """Where nothing can be learned every score is the share of toxic labels, not one half."""
    for n in (10, 30, 60):
        corpus = [(i, f"only text number {i}", int(i % 10 == 3)) for i in range(n)]
        docs, labels = _frames(rows, corpus)
        train = [y for i, _, y in corpus if zlib.crc32(str(i).encode()) % 5]
        found = toxicity.toxicity(docs, labels).collect()
        assert np.allclose([r["score"] for r in found], np.mean(train), atol=1e-9) and 0 < np.mean(train) < 0.5
        assert toxicity.drop_toxic(docs, labels).count() == n


def test_texts_without_known_words_are_not_toxic(rows):
    docs, labels = _frames(rows, _corpus(300, seed=6))
    model = toxicity.train(docs, labels)
    assert (model.score(["", "unheard of", "%%"], {}) < 0.35).all()


def test_samples_are_bounded_where_rows_repeat(rows):
    corpus = _corpus(60, seed=7)
    docs, labels = _frames(rows, corpus)
    many = _copies(docs, 64)
    other = rows(DOCS, *[(1, f"text {k} of one id", None, "s", 1, 2, "p") for k in range(300)])
    told = toxicity._labelled(labels, "doc_id")
    sample = toxicity._sample(many.union(other), told, "doc_id", "text", 8)
    assert {r["toxic"]: r["count"] <= 8 for r in sample.groupBy("toxic").count().collect()} == {0: True, 1: True}
    assert toxicity._sample(docs, told, "doc_id", "text", 1000).count() == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i, _, _ in corpus)
    once, often = (sorted(r["score"] for r in toxicity.toxicity(d, labels).select("doc_id", "score").distinct().collect()) for d in (docs, many))
    assert np.allclose(once, often)


def test_toxicity_equals_a_plain_refit(rows):
    """The same features, chosen and fitted in numpy on dense arrays by plain gradient descent."""
    corpus = _corpus(250, seed=8)
    docs, labels = _frames(rows, corpus)
    train = [(t, y) for i, t, y in corpus if zlib.crc32(str(i).encode()) % 5]
    sets = [toxicity._features(toxicity._words(t)) for t, _ in train]
    y = np.array([y for _, y in train], float)
    n, positive = len(y), y.sum()
    scored = []
    for f in sorted(set().union(*sets)):
        has = np.array([f in s for s in sets])
        k = has.sum()
        chi2 = (y[has].sum() - k * positive / n) ** 2 / max(k * positive / n * (1 - positive / n) * (n - k) / (n - 1), 1e-9)
        if k >= toxicity.MIN_ROWS and chi2 >= toxicity.MIN_CHI2:
            scored.append(f)
    x = np.array([[1.0, *(f in s for f in scored)] for s in sets])
    weight, w = np.where(y == 1, 0.5 / positive, 0.5 / (n - positive)), np.zeros(len(scored) + 1)
    for _ in range(200_000):
        slope = x.T @ (weight * (1 / (1 + np.exp(-x @ w)) - y)) + 2 * toxicity.RIDGE * np.r_[0, w[1:]]
        w -= 0.8 * slope
        if abs(slope).max() < 1e-7:
            break
    w[0] = min(w[0], np.log(positive / (n - positive)))
    found = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, labels).collect()}
    for i, text, _ in corpus:
        present = toxicity._features(toxicity._words(text))
        odds = w[0] + sum(c for f, c in zip(scored, w[1:]) if f in present)
        assert abs(found[i] - 1 / (1 + np.exp(-odds))) < 0.01


TONGUES = {"xx": "abcdeaio", "yy": "klmnopuu", "zz": "rstvwyae"}


def _sentences(n, seed=5):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(sorted(TONGUES))
        words = ["".join(rng.choice(TONGUES[lang]) for _ in range(rng.randrange(2, 8))) for _ in range(rng.randrange(4, 40))]
        out.append((i, " ".join(words), lang))
    return out


def test_languages_on_held_out_rows(rows):
    corpus = _sentences(500)
    docs = rows(DOCS, *[(i, t, y, "s", 1, 2, "p") for i, t, y in corpus])
    found = {r["doc_id"]: r for r in language_id.language_id(docs).collect()}
    held = [(found[i]["lang_pred"], y) for i, _, y in corpus if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 80 and np.mean([a == b for a, b in held]) > 0.98
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for i, r in found.items())


def test_languages_of_odd_texts(spark, rows):
    corpus = _sentences(200)
    odd = [(None, None, None), (300, "", "xx"), (301, "12 345 !?", "yy"), (302, "abca" * 20_000, None), (302, "klmo " * 9, None), (303, "é", None)]
    docs = rows(DOCS, *[(i, t, y, "s", 1, 2, "p") for i, t, y in corpus + odd])
    found = language_id.language_id(docs).collect()
    assert len(found) == 206
    by_id = {}
    for r in found:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert by_id[None][0]["lang_pred"] == by_id[300][0]["lang_pred"] == by_id[301][0]["lang_pred"] == "und"
    assert sorted(r["lang_pred"] for r in by_id[302]) == ["xx", "yy"]
    assert by_id[303][0]["lang_pred"] in TONGUES
    assert language_id.language_id(docs.limit(0)).collect() == []
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) AS lang")
    assert {(r["lang_pred"], r["score"]) for r in language_id.language_id(unlabelled).collect()} == {("und", 0.0)}


def test_language_sample_is_bounded_and_rare_values_are_not_learned(rows):
    corpus = _sentences(80, seed=9)
    docs = rows(DOCS, *[(i, t, y, "s", 1, 2, "p") for i, t, y in corpus])
    many = _copies(docs, 8)
    assert language_id.train(many, rows=30).weights.shape[0] <= 30
    once, often = (language_id.train(d, rows=4000) for d in (docs, many))
    assert np.allclose(once.weights, often.weights)
    dirty = many.union(rows(DOCS, *[(500 + k, "abc dea", f"junk{k}", "s", 1, 2, "p") for k in range(40)]))
    assert language_id.train(dirty, min_share=0.01).languages == sorted(TONGUES)


def test_languages_equal_a_plain_refit(rows):
    """Dense kernels of all rows and the first rows of each language as landmarks, in double precision."""
    corpus = _sentences(120, seed=10)
    docs = rows(DOCS, *[(i, t, y, "s", 1, 2, "p") for i, t, y in corpus])
    model = language_id.train(docs, landmarks=24)
    train = [(t, y) for i, t, y in corpus if zlib.crc32(str(i).encode()) % 4 != 2]
    grams = lambda t: frozenset(np.flatnonzero(language_id.presence(language_id.segments(t)[0])).tolist())
    value = lambda a, b: len(a & b) / np.sqrt(len(a) * len(b))
    chosen = [frozenset(model_row) for model_row in (np.flatnonzero(model.bins)[r > 0].tolist() for r in model.landmarks)]
    assert len(chosen) == 24 and set(chosen) <= {grams(t) for t, _ in train}
    wide = np.array([[value(grams(t), c) for c in chosen] for t, _ in train])
    among = np.array([[value(a, b) for a in chosen] for b in chosen])
    y = np.array([[lang == x for x in sorted(TONGUES)] for _, lang in train], float)
    system = wide.T @ wide + language_id.RIDGE * len(train) * among + 1e-9 * len(train) * np.eye(len(chosen))
    weights = np.linalg.solve(system, wide.T @ y)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.language_id(docs, landmarks=24).collect()}
    for i, text, _ in corpus:
        values = np.array([value(grams(text), c) for c in chosen]) @ weights
        assert found[i][0] == sorted(TONGUES)[int(values.argmax())] and abs(found[i][1] - min(1, max(0, values.max()))) < 1e-3


def test_a_long_quotation_counts_by_its_length(rows):
    corpus = _sentences(300, seed=6)
    docs = rows(DOCS, *[(i, t, y, "s", 1, 2, "p") for i, t, y in corpus])
    model = language_id.train(docs)
    quoted = "abc ade oia " * 300 + "klm onp " * 200 + "bca dea " * 200
    assert model.predict([quoted])[0] == ["xx"]


def test_kernel_is_the_share_of_common_ngrams():
    a, b = (language_id.presence(language_id.segments(t)[0]) for t in ("abab", "abac"))
    flags = np.stack([a, b])
    values = language_id.kernel(flags, flags)
    assert np.allclose(np.diag(values), 1)
    assert np.isclose(values[0, 1], (a & b).sum() / np.sqrt(a.sum() * b.sum()))
    grams = {"abab"[i : i + n] for n in (1, 2, 3) for i in range(5 - n)}
    assert a.sum() == len(grams)
