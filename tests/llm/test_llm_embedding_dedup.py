"""Embedding near-dedup against all pairs."""

import numpy as np
import pytest

from hostelry.llm.embedding_dedup import embedding_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int, c string, n string, key int, t int, chunk int"


def _frame(rows, vectors, labels, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return rows(SCHEMA, *[(i, None if v is None else [None if x is None else float(x) for x in v], l, "c", "n", 1, 2, 3) for i, v, l in zip(ids, vectors, labels)])


def _brute(vectors, labels):
    x = np.array([np.float32(v) for v in vectors], np.float64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.98) & (np.array(labels)[:, None] == np.array(labels)[None, :])
    np.fill_diagonal(linked, False)
    least = np.arange(len(x))
    for _ in range(len(x)):
        least = np.minimum(least, np.where(linked, least[None, :], len(x)).min(axis=1))
    return linked.sum(axis=1).tolist(), least.tolist()


def _clusters(seed, groups, size, dim, spread):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, dim))
    return [c + spread * rng.standard_normal(dim) for c in centres for _ in range(size)]


@pytest.mark.parametrize("chunk", [512, 7])
def test_links_and_components_equal_all_pairs(rows, chunk):
    """Small chunks deal a bucket over many blocks."""
    vectors = _clusters(1, 12, 15, 32, 0.08) + _clusters(2, 1, 30, 32, 0.0)
    labels = [i % 2 for i in range(180)] + [1] * 30
    found = sorted(tuple(r) for r in embedding_duplicates(_frame(rows, vectors, labels), chunk=chunk).collect())
    links, least = _brute(vectors, labels)
    assert sum(links) > 500
    recall = sum(r[1] for r in found) / sum(links)
    assert 0.99 <= recall <= 1.0
    assert [r[2] for r in found] == least
    assert all(r[3] == (r[0] == r[2]) for r in found)


def test_no_link_below_the_threshold(rows):
    angle = np.arccos(0.9799)
    vectors = [[1, 0], [np.cos(angle), np.sin(angle)], [2, 0], [0, 1]]
    found = sorted(tuple(r)[:3] for r in embedding_duplicates(_frame(rows, vectors, [1] * 4)).collect())
    assert found == [(0, 1, 0), (1, 0, 1), (2, 1, 0), (3, 0, 3)]


def test_vectors_that_link_with_nothing(rows):
    good = [1.0, 2.0, 3.0]
    vectors = [good, good, None, [], [0.0, 0.0, 0.0], [1.0, None, 3.0], [1.0, float("nan"), 3.0], [1.0, float("inf"), 3.0], good, good, good, [1.0, 2.0]]
    labels = [1, 1, 1, 1, 1, 1, 1, 1, None, 2, 1, 1]
    ids = [*range(10), None, 11]
    found = {r["vec_id"]: tuple(r)[1:] for r in embedding_duplicates(_frame(rows, vectors, labels, ids)).collect()}
    assert found[0] == (1, 0, True) and found[1] == (1, 0, False)
    assert all(found[i] == (0, i, True) for i in [*range(2, 10), 11])
    assert found[None] == (0, None, True)


def test_repeated_ids_and_empty_table(spark, rows):
    found = [tuple(r) for r in embedding_duplicates(_frame(rows, [[1, 0], [1, 0], [0, 1]], [1, 1, 1], [4, 4, 4])).collect()]
    assert sorted(found) == [(4, 0, 4, True), (4, 1, 4, True), (4, 1, 4, True)]
    assert embedding_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_huge_components_do_not_overflow(rows):
    frame = rows("vec_id long, embedding array<double>, label int", (1, [1e200, 1e200], 1), (2, [2e200, 2e200], 1), (3, [1e-200, 1e-200], 1))
    assert sorted(tuple(r)[:3] for r in embedding_duplicates(frame).collect()) == [(1, 2, 1), (2, 2, 1), (3, 2, 1)]
