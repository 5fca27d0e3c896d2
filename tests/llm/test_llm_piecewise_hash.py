"""Piecewise hashing against plain loops, and likeness of edited, copied and other texts."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hostelry.llm import piecewise_hash as P

SCHEMA = "doc_id long, text string, n_chars int, fingerprint long, range string, row string"


def _distance(a, b):
    """Insertions and deletions, by the whole table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal if x == y else 1 + min(row[j], row[j - 1])
    return row[-1]


def test_edit_distance_equals_the_table():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(40))] for _ in range(2))
        assert P.edit_distance(a, b) == _distance(a, b)
    assert P.edit_distance([1] * 300, [1] * 200 + [2]) == 101


def test_boundaries_do_not_depend_on_the_stride(monkeypatch):
    text = "".join(random.Random(2).choices("abcdefgh 日é", k=5000))
    whole = P.fingerprint(text)
    monkeypatch.setattr(P, "_STRIDE", 64)
    assert P.fingerprint(text) == whole


def test_boundaries_follow_the_last_code_points():
    """After a prefix of another length the same chunks end at the same places."""
    tail = "".join(random.Random(3).choices("abcdefgh ", k=3000))
    ends = [P._boundaries(np.frombuffer((head + tail).encode("utf-32-le"), "<u4"), 24)[0] for head in ("", "x" * 37)]
    a, b = (set(e.tolist()) for e in (ends[0], ends[1] - 37))
    assert {e for e in a if e > P.REACH} == {e for e in b if e > P.REACH} and len(a) > 60
    assert np.array_equal(ends[0][P._boundaries(np.frombuffer(tail.encode("utf-32-le"), "<u4"), 24)[1]],
                          P._boundaries(np.frombuffer(tail.encode("utf-32-le"), "<u4"), 48)[0])


def test_block_size_and_odd_texts():
    assert [P.block_size(n) for n in (0, 192, 193, 400, 2_000_000)] == [3, 3, 6, 12, 49152]
    empty = P.fingerprint("")
    assert P.written(empty) == "3::" and P.likeness(empty, empty) == 1.0
    assert P.likeness(empty, P.fingerprint("a")) == 0.0
    for text in ("a", "a" * 300_000, "word " * 400_000, "\n" * 1000, "日本" * 500):
        assert P._read(P.written(P.fingerprint(text))) == P.fingerprint(text)
        assert P.likeness(P.fingerprint(text), P.fingerprint(text)) == 1.0


def test_likeness_tells_edits_from_other_texts():
    rng = random.Random(4)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randrange(2, 9))) for _ in range(400)]
    made = [" ".join(rng.choices(words, k=k)) for k in (40, 200, 1000, 5000, 20_000)]
    other = [" ".join(rng.choices(words, k=k)) for k in (40, 200, 1000, 5000, 20_000)]
    for text, after in zip(made, other):
        own = P.fingerprint(text)
        assert P.likeness(own, P.fingerprint(P.edited(text, after))) > 0.35
        assert P.likeness(own, P.fingerprint(text[: len(text) // 3] + "an insertion" + text[len(text) // 3 :])) > 0.8
        assert P.likeness(own, P.fingerprint(after)) < 0.2


def _key(row):
    return row[0] is not None, row[0] or 0, *row[1:3]


def _expected(data, order):
    out = []
    for k, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        a, b, c = map(P.fingerprint, (text, changed, after))
        out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), P.written(a), P.written(b), P.likeness(a, b), P.likeness(a, c)))
    return sorted(out, key=_key)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_rows_equal_a_plain_loop(rows, spark, parts):
    rng = random.Random(parts)
    texts = ["".join(rng.choices("abcd é日\n", k=rng.randrange(0, 900))) for _ in range(30)] + ["", None, "x" * 5000, "", "é"]
    data = [(i * 7 - 50, t) for i, t in enumerate(texts)]
    rng.shuffle(data)
    docs = rows(SCHEMA, *[(i, t, 1, 2, "r", "s") for i, t in data])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        found = P.edit_likeness(docs).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert sorted((tuple(r) for r in found), key=_key) == _expected(data, sorted(data, key=lambda d: d[0]))


def test_null_ids_repeated_rows_and_tiny_tables(rows):
    one = P.edit_likeness(rows(SCHEMA, (5, "alone in here", 1, 2, "r", "s"))).collect()
    assert [tuple(r) for r in one] == _expected(None, [(5, "alone in here")])
    assert P.edit_likeness(rows(SCHEMA)).collect() == []
    data = [(None, "without id"), (1, "same row"), (1, "same row"), (1, "same row"), (2, None)]
    found = P.edit_likeness(rows(SCHEMA, *[(i, t, 1, 2, "r", "s") for i, t in data])).collect()
    assert sorted((tuple(r) for r in found), key=_key) == _expected(data, data)


def test_fingerprints_and_likeness_as_columns(rows):
    docs = rows(SCHEMA, (1, "some text of a document", 1, 2, "r", "s"), (2, "some text of a document", 1, 2, "r", "s"), (3, None, 1, 2, "r", "s"))
    found = P.fingerprints(docs)
    both = found.alias("a").join(found.alias("b"), F.col("a.doc_id") < F.col("b.doc_id"))
    near = both.select("a.doc_id", F.col("b.doc_id").alias("other"), P.fingerprint_likeness(F.col("a.fingerprint"), F.col("b.fingerprint")).alias("near"))
    assert {(r[0], r[1]): r[2] for r in near.collect()} == {(1, 2): 1.0, (1, 3): 0.0, (2, 3): 0.0}


def test_a_text_of_two_megabytes(rows):
    docs = rows(SCHEMA, (1, "word " * 440_000, 1, 2, "r", "s"), (2, "é" * 1_100_000, 1, 2, "r", "s"))
    found = {r["doc_id"]: r for r in P.edit_likeness(docs).collect()}
    assert found[1]["n_chars"] == 2_200_000 and 0 <= found[1]["near_edited"] <= 1
