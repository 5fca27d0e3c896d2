"""Exact dedup, SimHash dedup and connected components against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hostelry.llm import exact_dedup, simhash
from hostelry.llm.components import connected_components, spanning_forest

CLASHING = "doc_id long, text string, row string, name int, level string, h int, key string, u long, _copy int"


def _docs(rows, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return rows(CLASHING, *[(i, t, "r", 7, "l", 1, "k", 5, 3) for i, t in zip(ids, texts)])


def _reach(n, links):
    """Least reachable index of each of n nodes."""
    least = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            if least[a] != low or least[b] != low:
                least[a] = least[b] = low
                changed = True
    return least


def _exact(ids, texts):
    normal = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in texts]
    out = []
    for i, n in zip(ids, normal):
        group = [j for j, m in zip(ids, normal) if m == n]
        keep = min(group)
        out.append((i, keep, len(group), i == keep, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out)


TEXTS = ["a b", "a  b", "a\tb", "a\n\r b ", "", None, "  ", "x" * 9, "x" * 10, "x" * 9, "ab" * 40, "ab" * 40, "ab" * 39 + "ac",
         "é" * 33, "é" * 33, "a b", "ba" * 40, "a b"]


@pytest.mark.parametrize("block_bytes, hash_bits", [(8, 64), (3, 2), (16384, 64)])
def test_exact_duplicates_with_any_block_and_hash(rows, block_bytes, hash_bits):
    """Two-bit hashes collide all the time; no texts are joined by that."""
    found = exact_dedup.exact_duplicates(_docs(rows, TEXTS), block_bytes=block_bytes, hash_bits=hash_bits)
    got = sorted(tuple(r) for r in found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())
    assert got == _exact(range(len(TEXTS)), TEXTS)


def test_exact_duplicates_of_repeated_and_null_ids(rows):
    ids, texts = [1, 1, 1, None, None, 2, None], ["a", "a", "b", "a", "c", "b", "c"]
    found = exact_dedup.exact_duplicates(_docs(rows, texts, ids))
    got = sorted((r["keep_id"] or -1, r["group_size"], r["kept"]) for r in found.collect())
    assert got == [(-1, 2, False), (-1, 2, True), (1, 2, False), (1, 2, True), (1, 3, False), (1, 3, False), (1, 3, True)]


def test_exact_plan_has_no_python(rows):
    plan = exact_dedup.exact_duplicates(_docs(rows, TEXTS))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|NestedLoop|Cartesian", plan)


def test_drop_exact_duplicates_keeps_columns_and_one_row_each(rows):
    docs = _docs(rows, ["a\t", "a ", "a\t", "b", None, "", "a\t"], [3, 2, 3, 3, 9, None, 2])
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    got = sorted((r["doc_id"], r["text"] or "") for r in kept.collect())
    assert [x[0] for x in got] == [2, 3, 9] and got[1:] == [(3, "b"), (9, "")]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], CLASHING)
    assert exact_dedup.exact_duplicates(empty).collect() == []
    assert exact_dedup.drop_exact_duplicates(empty).collect() == []
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.drop_near_duplicates(empty).collect() == []


def _fingerprint(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _variants(seed, groups, copies, words):
    rng = random.Random(seed)
    texts = []
    for _ in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(words)]
        for _ in range(copies):
            own = list(base)
            own[rng.randrange(words)] = "Changed"
            texts.append(" ".join(own))
    return texts


def test_simhash_components_equal_brute_force(rows):
    texts = _variants(1, 12, 8, 120) + ["", None, " \n", "One", "one", "two words", "a b c d e f"]
    found = {r["doc_id"]: r for r in simhash.near_duplicates(_docs(rows, texts)).collect()}
    prints = [_fingerprint(t) for t in texts]
    assert [found[i]["fingerprint"] for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    near = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    assert [found[i]["component_id"] for i in range(len(texts))] == _reach(len(texts), near)
    assert len({r["component_id"] for r in found.values()}) < len(set(prints))


@pytest.mark.parametrize("segments", [(22, 21, 21), (32, 32), (13, 13, 13, 13, 12)])
def test_near_links_find_every_pair(spark, segments):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, 20, dtype=np.uint64)
    nodes = {int(c) for c in centres}
    for c in centres:
        for flips in range(1, 8):
            nodes.add(int(c) ^ sum(1 << int(b) for b in rng.choice(64, flips, replace=False)))
    signed = [x - 2**64 if x >= 2**63 else x for x in nodes]
    links = simhash.near_links(spark.createDataFrame([(x,) for x in signed], "f long"), 4, segments)
    got = {tuple(r) for r in links.collect()}
    expected = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    assert got == expected


def test_widths_follow_the_count_and_links_do_not(spark):
    assert simhash.choose_segments(0) == simhash.choose_segments(10**6) == (22, 21, 21)
    assert simhash.choose_segments(10**8) == simhash.choose_segments(10**10) == (32, 32)
    for widths in [(22, 21, 21), (32, 32)]:
        assert sum(widths) == 64
        assert sum(r + 1 for r in simhash.radii(4, len(widths))) > 4
    probes, entries = simhash._balls(32, 2)
    assert len(probes) == len(entries) == 33
    assert {a ^ b for a in probes for b in entries} == set(simhash._ball(32, 2))
    chosen = simhash.near_links(spark.createDataFrame([(0,), (15,), (31,), (-1,)], "f long"))
    assert {tuple(r) for r in chosen.collect()} == {(0, 15), (15, 31)}


@pytest.mark.parametrize("pairs, nodes", [(1, 3), (50, 1000), (1 << 17, 1 << 20)])
def test_spanning_forest_keeps_components_with_few_edges(spark, pairs, nodes):
    rng = random.Random(6)
    clique = [(a, b) for a in range(120) for b in range(a)]
    path = [(1000 + i, 1001 + i) for i in range(50)]
    edges = [*clique, *path, (5000, 5000), (None, 3), *((rng.randrange(6000, 6200), rng.randrange(6000, 6200)) for _ in range(90))]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "u long, v long").repartition(3)
    forest = spanning_forest(df, pairs, nodes)
    expected = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert {r["node"]: r["component"] for r in connected_components(forest).collect()} == expected
    if nodes > 500:
        assert forest.count() < 3 * len(expected) < len(clique)
    assert spanning_forest(df.where(F.lit(False))).collect() == []


def test_simhash_of_a_text_of_two_megabytes(rows):
    texts = ["word " * 400_000, "word " * 400_001, "x" * 2_000_000]
    found = {r["doc_id"]: r for r in simhash.near_duplicates(_docs(rows, texts)).collect()}
    assert [found[i]["component_id"] for i in range(3)] == [0, 0, 2]
    assert found[2]["fingerprint"] == f"{_fingerprint(texts[2]):016x}"


def test_drop_near_duplicates(rows):
    texts = _variants(2, 2, 3, 200)
    docs = _docs(rows, texts + ["other"], [5, 4, 3, 9, 8, 7, 1])
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    components = {r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert {r["doc_id"] for r in kept.collect()} == components


def test_connected_components_of_paths_stars_and_loops(spark):
    rng = random.Random(3)
    order = list(range(0, 60))
    rng.shuffle(order)
    links = list(zip(order, order[1:])) + [(100, 100 + i) for i in range(1, 40)] + [(200, 200), (300, 301), (301, 300), (301, 302)]
    edges = spark.createDataFrame([*links, (None, 4)], "u long, v long")
    found = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    expected = {**dict.fromkeys(range(60), 0), **dict.fromkeys(range(100, 140), 100), **dict.fromkeys((300, 301, 302), 300)}
    assert found == expected
    assert connected_components(edges.where(F.lit(False))).collect() == []
