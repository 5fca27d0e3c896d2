"""Line dedup against plain counting; the index after insertions and deletions; the filter."""

import hashlib
import random
from collections import Counter

import numpy as np

from hostelry.llm import line_dedup
from hostelry.llm.cuckoo import CuckooFilter

SCHEMA = "doc_id long, text string, h1 string, shard int, copies string, drops int"
LONG = [f"Line number {i} is long enough to count as one of them" for i in range(12)]


def _docs(rows, texts, ids=None):
    return rows(SCHEMA, *[(i, t, "h", 1, "c", 2) for i, t in zip(range(len(texts)) if ids is None else ids, texts)])


def _brute(texts, known=None, min_docs=5):
    """known: all (doc_id, text) that are counted."""
    known = list(enumerate(texts)) if known is None else known
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    held, holder = Counter(), {}
    for i, t in known:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= 40:
                held[k] += 1
                holder[k] = max(holder.get(k, -1), i)
    out = []
    for i, t in enumerate(texts):
        lines = (t or "").split("\n")
        kept = [x for x in lines if held[key(x)] < min_docs or holder[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def _texts(seed, n):
    rng = random.Random(seed)
    pool = LONG + [f"short {i}" for i in range(4)] + ["", "É" * 45, "é" * 39]
    vary = lambda x: rng.choice([x, x.upper() if x.isascii() else x, f" \t{x}\r", x])
    return ["\n".join(vary(rng.choice(pool)) for _ in range(rng.randrange(0, 9))) for _ in range(n)] + [None, ""]


def _digests(frame):
    return sorted(tuple(r)[:4] for r in frame.collect())


def test_line_dedup_equals_counting(rows):
    texts = _texts(1, 60)
    assert _digests(line_dedup.line_dedup(_docs(rows, texts))) == _brute(texts)


def test_many_small_groups_give_the_same(rows):
    """Several shards, and several copies of each filter."""
    texts = _texts(2, 80)
    docs = _docs(rows, texts)
    index = line_dedup.build_index(docs, shard_keys=3)
    assert index.shards > 2
    assert _digests(line_dedup.clean_lines(index, docs, group_lines=10)) == _brute(texts)


def test_insertions_and_deletions_are_reversible(rows):
    first, second = _texts(3, 30), _texts(4, 30)
    both = first + second
    a, b = _docs(rows, first), _docs(rows, second, range(len(first), len(both)))
    every = _docs(rows, both)
    index = line_dedup.build_index(a, shard_keys=3)
    grown = line_dedup.insert_documents(index, b)
    assert _digests(line_dedup.clean_lines(grown, every)) == _brute(both)
    shrunk = line_dedup.delete_documents(grown, b)
    assert _digests(line_dedup.clean_lines(shrunk, a)) == _brute(first)
    assert sorted(map(tuple, shrunk.counts.collect())) == sorted(map(tuple, index.counts.collect()))
    emptied = line_dedup.delete_documents(shrunk, a)
    assert emptied.references.count() == 0
    assert _digests(line_dedup.clean_lines(emptied, a)) == _brute(first, known=[])


def test_null_ids_hold_no_line_and_repeated_ids_hold_together(rows):
    text = LONG[0]
    docs = _docs(rows, [text] * 6, [None, None, 1, 2, 3, 3])
    found = sorted((r["doc_id"] or 0, r["n_dropped"]) for r in line_dedup.line_dedup(docs).collect())
    assert found == [(0, 1), (0, 1), (1, 1), (2, 1), (3, 0), (3, 0)]


def test_empty_table(spark):
    assert line_dedup.line_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_cuckoo_filter_inserts_deletes_and_fills_up():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(-(2**63), 2**63 - 1, 3000))
    held = CuckooFilter(CuckooFilter.room_for(len(keys)))
    held.insert(keys)
    assert held.might_hold(keys).all()
    assert held.might_hold(rng.integers(-(2**63), 2**63 - 1, 20000)).mean() < 0.002
    again = CuckooFilter(held.buckets, held.tobytes())
    again.delete(keys[:1500])
    assert again.might_hold(keys[1500:]).all()
    assert again.might_hold(keys[:1500]).mean() < 0.01
    try:
        CuckooFilter(4).insert(keys)
        raise AssertionError("a full filter must say so")
    except CuckooFilter.Full:
        pass
