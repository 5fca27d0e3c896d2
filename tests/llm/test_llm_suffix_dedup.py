"""Suffix dedup against a brute-force search of all strings."""

import hashlib
import random

import pytest

from hostelry.llm.suffix_dedup import drop_repeats, remove_repeats

SCHEMA = "doc_id long, text string, n long, x string, docno int, marks string, spans int"


def _brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d, t in enumerate(data):
        for p in range(len(t) - length + 1):
            seen.setdefault(t[p : p + length], []).append((d, p))
    gone = [bytearray(len(t)) for t in data]
    for places in seen.values():
        if len(places) > 1:
            for d, p in places:
                gone[d][p : p + length] = b"\1" * length
    out = []
    for t, g in zip(data, gone):
        left = bytes(c for c, x in zip(t, g) if not x)
        runs = sum(1 for i, x in enumerate(g) if x and (i == 0 or not g[i - 1]))
        out.append((len(t), sum(g), runs, hashlib.sha256(left).hexdigest()))
    return out


def _corpus(seed, alphabet, length):
    """Random texts with pasted passages of lengths around the threshold, some with edits."""
    rng = random.Random(seed)
    make = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    passages = [make(n) for n in (length - 1, length, length + 1, length + 13, 2 * length, 5 * length)]
    texts = []
    for _ in range(40):
        text = make(rng.randrange(0, 3 * length))
        for _ in range(rng.randrange(0, 4)):
            passage = rng.choice(passages)
            if rng.random() < 0.5:
                at = rng.randrange(len(passage))
                passage = passage[:at] + "#" + passage[at + 1 :]
            text += passage + make(rng.randrange(0, length // 2))
        texts.append(text)
    return texts + ["", None, make(length - 1), passages[1], passages[1], "z" * (3 * length), make(50) * 8]


@pytest.mark.parametrize("seed, alphabet, gap, split_rows", [
    (1, "abcdefghijklmnopqrstuvwxyz ", 24, 4096),
    (2, "ab", 20, 4096),
    (3, "éaß日 b", 26, 4096),
    (4, "abcdefgh ", 24, 2),
])
def test_same_bytes_go_as_in_a_full_search(rows, seed, alphabet, gap, split_rows):
    texts = _corpus(seed, alphabet, 60)
    docs = rows(SCHEMA, *[(i, t, 1, "x", 2, "m", 3) for i, t in enumerate(texts)])
    found = remove_repeats(docs, length=60, gap=gap, split_rows=split_rows)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found.collect()}
    expected = _brute(texts, 60)
    assert [got[i] for i in range(len(texts))] == expected
    assert 0 < sum(e[1] for e in expected) < sum(e[0] for e in expected)


def test_repeated_rows_null_ids_and_short_texts(rows):
    long = "".join(chr(97 + i * i % 23) + str(i) for i in range(200))
    texts, ids = [long, long, long[:399], None, "other" * 20, long[100:]], [1, 1, 2, None, None, None]
    docs = rows(SCHEMA, *[(i, t, 1, "x", 2, "m", 3) for i, t in zip(ids, texts)])
    found = sorted((r["n_bytes"], r["n_removed"]) for r in remove_repeats(docs).collect())
    expected = sorted((e[0], e[1]) for e in _brute(texts, 400))
    assert found == expected


def test_texts_whose_first_keys_collide(rows, monkeypatch):
    """Half of the 128 bits that stand for a text may agree for all texts."""
    from pyspark.sql import functions as F

    from hostelry.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "text_key", lambda column="text": F.lit(7).cast("long"))
    texts = _corpus(9, "abcdefgh ", 60)
    docs = rows(SCHEMA, *[(i, t, 1, "x", 2, "m", 3) for i, t in enumerate(texts)])
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in remove_repeats(docs, length=60, gap=24).collect()}
    assert [got[i] for i in range(len(texts))] == _brute(texts, 60)


def test_the_two_keys_of_a_text_are_not_functions_of_each_other(spark):
    from pyspark.sql import functions as F

    from hostelry.llm.suffix_dedup import _second_key

    made = spark.range(200).select(F.col("id").cast("string").alias("text"))
    chained = F.xxhash64(F.xxhash64("text")) == _second_key("text")
    assert made.where(chained | (F.xxhash64("text", F.lit(1)) == _second_key("text"))).count() == 0


def test_empty_table_and_too_wide_gap(spark, rows):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        remove_repeats(spark.createDataFrame([], SCHEMA), length=100, gap=60)


def test_drop_repeats_keeps_rows_and_columns(rows):
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefghij ") for _ in range(500))
    texts = ["left " + passage + " right", "é" + passage, "alone", None]
    docs = rows(SCHEMA, *[(i, t, 10 + i, "x", 2, "m", 3) for i, t in enumerate(texts)])
    kept = drop_repeats(docs)
    assert kept.columns == docs.columns
    got = {r["doc_id"]: (r["text"], r["n"]) for r in kept.collect()}
    assert got == {0: ("left  right", 10), 1: ("é", 11), 2: ("alone", 12), 3: (None, 13)}


def test_shared_passages_go_by_their_bytes_not_their_words(rows):
    """A passage of over 50 words stays while it is under 400 bytes; the pipeline's shorter threshold takes it."""
    from corpus_pipeline import PASSAGE_BYTES, PASSAGE_GAP

    rng = random.Random(21)
    words = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(n))
    short, long = words(55), words(70)
    assert PASSAGE_BYTES <= len(short) < 400 <= len(long)
    texts = [f"{words(90)} {passage} {words(90)}" for passage in (short, short, long, long, words(70))]
    docs = rows(SCHEMA, *[(i, t, 1, "x", 2, "m", 3) for i, t in enumerate(texts)])
    for length, settings in ((400, {}), (PASSAGE_BYTES, {"length": PASSAGE_BYTES, "gap": PASSAGE_GAP})):
        found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in remove_repeats(docs, **settings).collect()}
        assert [found[i] for i in range(len(texts))] == _brute(texts, length)
        assert [found[i][0] for i in range(len(texts))] == [len(t) for t in texts]
        assert [found[i][2] for i in range(len(texts))] == ([0, 0, 1, 1, 0] if length == 400 else [1, 1, 1, 1, 0])


def test_long_repeats_take_no_more_tables_than_short_ones(rows, monkeypatch):
    """Runs of phrases are looked up in one round, whatever their length."""
    from hostelry.llm import suffix_dedup

    names = []
    plain = suffix_dedup.stored
    monkeypatch.setattr(suffix_dedup, "stored", lambda df, name, **settings: names.append(name) or plain(df, name, **settings))
    rng = random.Random(31)
    make = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    passage = make(2000)
    texts = [make(90) + passage + make(70), passage[300:] + make(50), make(40) + passage[:700] + "#" + passage[701:], make(800)]
    docs = rows(SCHEMA, *[(i, t, 1, "x", 2, "m", 3) for i, t in enumerate(texts)])
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in remove_repeats(docs, length=400, gap=40).collect()}
    assert [found[i] for i in range(len(texts))] == _brute(texts, 400)
    assert len(names) == len(set(names)) <= 12


@pytest.mark.parametrize("block, together", [(1 << 17, 1 << 20), (7, 900), (64, 1)])
def test_anchors_of_texts_searched_together_are_those_of_each(monkeypatch, block, together):
    from hostelry.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "_BLOCK", block)
    monkeypatch.setattr(suffix_dedup, "_TOGETHER", together)
    rng = random.Random(3)
    for gap in (2, 3, 20, 33):
        texts = [bytes(rng.choice(b"abcdef"[: 2 + k % 5]) for _ in range(rng.randrange(gap + 7, 400))) for k in range(8)]
        texts += [b"abc" * 100, b"z" * (gap + 7), bytes(range(200))]
        for data, (same, x, lo) in zip(texts, suffix_dedup._anchors_of(texts, gap), strict=True):
            ranks = suffix_dedup._ranks(data, 0, len(data) - 7).tolist()
            lowest = [max(range(s, s + gap), key=lambda p: (-ranks[p], p)) for s in range(len(ranks) - gap + 1)]
            first = [s for s, p in enumerate(lowest) if not s or p != lowest[s - 1]]
            assert same is data
            assert (lo.tolist(), x.tolist()) == (first, [lowest[s] for s in first])
