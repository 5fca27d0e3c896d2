"""Periodic runs against a brute-force search of all stretches and periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from hostelry.llm.periodic_runs import find_runs, periodic_runs, seed_size

SCHEMA = "doc_id long, text string, n_runs int, start string, runs long"


def _brute(words, min_words=24, min_repeats=3):
    """Every maximal stretch per lag; those with a smaller period are left out."""
    n, out = len(words), []
    for q in range(1, n // min_repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(min_words, min_repeats * q):
                piece = words[i : i + length]
                if not any(piece[r:] == piece[:-r] for r in range(1, q)):
                    out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def _words(rng):
    """Random words over a small alphabet with repeated and nested pieces."""
    out = []
    for _ in range(rng.randrange(1, 6)):
        kind = rng.random()
        letters = "ab" if rng.random() < 0.5 else "abcdefghij"
        piece = [rng.choice(letters) for _ in range(rng.randrange(1, 40))]
        if kind < 0.3:
            inner = piece * rng.randrange(2, 5) + [rng.choice(letters)]
            piece = inner * rng.randrange(1, 5)
        elif kind < 0.8:
            whole = piece * rng.randrange(1, 9)
            piece = whole[: rng.randrange(1, len(whole) + 1)]
        out += piece
    return out


def _doubled_grams(rng):
    """A period in which every long gram occurs twice: x y x z, over and over."""
    x = [rng.choice("abc") for _ in range(rng.randrange(10, 60))]
    return (x + ["p"] + x + ["q"]) * rng.randrange(3, 6)


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_the_full_search(seed):
    rng = random.Random(seed)
    met = 0
    for k in range(60):
        words = _doubled_grams(rng) if k % 10 == 0 else _words(rng)
        numbers = np.unique(words, return_inverse=True)[1].astype(np.int64)
        wanted = _brute(words)
        met += len(wanted)
        assert find_runs(numbers) == wanted
    assert met > 30


@pytest.mark.parametrize("min_words, min_repeats", [(6, 3), (10, 3), (3, 3), (40, 4), (12, 5)])
def test_other_thresholds(min_words, min_repeats):
    rng = random.Random(min_words)
    for _ in range(40):
        words = _words(rng)
        numbers = np.unique(words, return_inverse=True)[1].astype(np.int64)
        assert find_runs(numbers, min_words, min_repeats) == _brute(words, min_words, min_repeats)


def test_two_repeats_are_refused(rows):
    with pytest.raises(ValueError):
        periodic_runs(rows(SCHEMA), min_repeats=2)


def test_every_run_holds_its_seed_twice():
    assert seed_size(24, 3) == 16
    assert min(max(24 - q, 2 * q) for q in range(1, 17)) >= 16


def _expected(doc_id, text, planted=True):
    words = [w for w in (text or "").translate({c: " " for c in range(9, 14)}).split(" ") if w]
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(words)
    if planted and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = _brute(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(runs), *shown, digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        digest(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_whole_rows(rows):
    rng = random.Random(5)
    texts = [" ".join(_words(rng)) for _ in range(80)]
    texts += ["", None, " \t\x0b\x0c\r\n ", "a", "    \x1c \x85 " * 30, "é ß\t日\n" * 40, texts[0], "w " * 3000]
    data = [(i, t, 1, "x", 2) for i, t in enumerate(texts)] + [(3, texts[3], 1, "x", 2), (None, "z y " * 40, 1, None, 2)]
    found = periodic_runs(rows(SCHEMA, *data), planted=True).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[7])
    assert sorted((tuple(r) for r in found), key=key) == sorted((_expected(d[0], d[1]) for d in data), key=key)
    assert sum(r["n_runs"] for r in found) > 40


def test_texts_and_runs_come_too(rows):
    found = periodic_runs(rows(SCHEMA, (1, "say " + "one two " * 15 + "end", 1, "x", 2)), with_text=True).first()
    assert found["runs"] == [[1, 30, 2]] and found["collapsed_text"] == "say one two end"
    assert found["exponent_milli"] == 15000


def test_empty_table(rows):
    assert periodic_runs(rows(SCHEMA)).collect() == []


def test_a_text_of_two_megabytes(rows):
    """One repeated word, and a long text whose period is half as long as the text allows."""
    long = " ".join(f"w{i}" for i in range(40_000)) + " "
    found = periodic_runs(rows(SCHEMA, (1, "word " * 440_000, 1, "x", 2), (2, long * 3, 1, "x", 2), (3, long * 2, 1, "x", 2)))
    got = {r["doc_id"]: (r["n_runs"], r["start"], r["length"], r["period"]) for r in found.collect()}
    assert got == {1: (1, 0, 440_000, 1), 2: (1, 0, 120_000, 40_000), 3: (0, None, None, None)}
