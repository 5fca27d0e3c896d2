"""Token counts, BPE codec and packing against the tokenizer library."""

import hashlib
import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hostelry import session
from hostelry.llm import bpe_codec, packing, token_counts
from hostelry.llm.vocabulary import Vocabulary, vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
SCHEMA = "doc_id long, text string, n_bytes string, ids int, row string, length int, slot string"
ODD = ["", None, "a" * 4000, " \n\n  x  \t\ty ", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "é" * 300, "'s 's's'S x'll", "\x1c\x1d a \x85\xa0b",
       "0123456789" * 30, "!!!???...,,,", "日本語 テキスト", "😀👨‍👩‍👧 x", "՘⵰ \U000e0001", "The quick brown fox", " " * 3000, "\n" * 2500 + "z"]


def _ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def _docs(rows, texts, ids=None):
    return rows(SCHEMA, *[(i, t, "n", 1, "r", 2, "s") for i, t in zip(range(len(texts)) if ids is None else ids, texts)])


def _mixed(seed, n):
    rng = random.Random(seed)
    parts = ["th", "er", "in", "g", " ", "ou", "\n", "the", "ion", "é", "aa", "a", "1", "'s", ".", "<|endoftext|>", "<|", "日"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 60))) for _ in range(n)]


def test_token_counts_equal_the_library(rows):
    texts = ODD + _mixed(1, 200)
    found = sorted(tuple(r) for r in token_counts.token_counts(_docs(rows, texts), PATH, limit=30).collect())
    expected = [(i, len((t or "").encode()), len(_ids(t)), len(_ids(t)) > 30) for i, t in enumerate(texts)]
    assert found == expected


def test_codec_equals_the_library(rows):
    texts = ODD + _mixed(2, 200)
    docs = _docs(rows, texts)
    encoded = bpe_codec.encode_documents(docs, PATH)
    got = {r["doc_id"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in encoded.collect()}
    assert [got[i] for i in range(len(texts))] == [_ids(t) for t in texts]
    decoded = {r["doc_id"]: r["text"] for r in bpe_codec.decode_documents(encoded, PATH).collect()}
    assert [decoded[i] for i in range(len(texts))] == [t or "" for t in texts]
    digests = {r["doc_id"]: tuple(r)[1:] for r in bpe_codec.codec_digests(docs, PATH).collect()}
    for i, t in enumerate(texts):
        ids = _ids(t)
        own = np.array(ids, "<u4").tobytes()
        assert digests[i] == (len(ids), hashlib.sha256(own).hexdigest(), hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abcdefghinorstuTHE  \n'.,1é日😀")), max_size=80))
def test_words_merge_as_in_the_library(text):
    vocab = vocabulary(PATH)
    assert "".join(vocab.words(text)) == text
    assert token_counts.Counter(vocab).counts([text]) == [len(_ids(text))]
    codec = bpe_codec.codec_of(PATH)
    ids = codec.encode([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == _ids(text)
    assert codec.decode(ids) == text


def test_pair_check_agrees_with_merging():
    vocab = vocabulary(PATH)
    speculator = bpe_codec.Speculator(vocab)
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 3000, (2, 4000))
    good = speculator.compatible(a, b)
    for x, y, ok in zip(a.tolist(), b.tolist(), good.tolist()):
        symbols, _ = token_counts.merge_words([vocab.bytes_of[x] + vocab.bytes_of[y]], vocab)
        assert ok == (symbols.tolist() == [x, y])


def test_broken_utf8_decodes_as_in_the_library():
    ids = [i for i, b in vocabulary(PATH).bytes_of.items() if b == b"\xe6"]
    assert bpe_codec.codec_of(PATH).decode(np.array(ids, "<u4").tobytes()) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_other_kinds_of_vocabulary_are_refused(tmp_path):
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    spec["pre_tokenizer"]["add_prefix_space"] = True
    other = tmp_path / "other.json"
    other.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        Vocabulary(str(other))


def _packed(frame, window):
    rows_ = [r.asDict() for r in frame.collect()]
    by_sequence, by_doc = {}, {}
    for r in rows_:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        by_doc.setdefault(r["doc_id"], []).append(r)
    for pieces in by_sequence.values():
        end = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == end and r["length"] > 0
            end += r["length"]
        assert end <= window
    return by_sequence, by_doc


@pytest.mark.parametrize("window, grid", [(64, 8), (2048, 8), (32, 4)])
def test_packing_holds_every_id_once(rows, window, grid):
    texts = ODD + _mixed(4, 150)
    frame = packing.pack_documents(_docs(rows, texts), PATH, window=window, grid=grid, with_ids=True)
    by_sequence, by_doc = _packed(frame, window)
    total = 0
    for i, t in enumerate(texts):
        ids = np.array([*_ids(t), 1], "<u4")
        total += len(ids)
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            part = ids[at : at + r["length"]].tobytes()
            assert (r["start"], r["doc_tokens"], r["ids_crc32"], bytes(r["ids"])) == (at, len(ids), zlib.crc32(part), part)
            at += r["length"]
        assert at == len(ids)
    # Little padding: rounding to the grid, and one open window.
    assert len(by_sequence) * window - total <= window + 3 * grid * len(by_sequence)
    joined = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(frame).collect()}
    assert sum(map(len, joined.values())) == 4 * total


def test_packing_of_repeated_ids_and_empty_table(spark, rows):
    by_sequence, by_doc = _packed(packing.pack_documents(_docs(rows, ["a b", "a b", "c"], [7, 7, None]), PATH), 2048)
    assert len(by_sequence) == 1 and len(by_doc[7]) == 2 and len(by_doc[None]) == 1
    empty = spark.createDataFrame([], SCHEMA)
    assert packing.pack_documents(empty, PATH).collect() == []
    assert token_counts.token_counts(empty, PATH).collect() == []
    assert bpe_codec.codec_digests(empty, PATH).collect() == []


def test_packing_writes_few_files_and_sorts_no_rows_by_length(spark, rows, monkeypatch):
    tables = {}
    own = packing.stored

    def recorded(df, name, **options):
        tables[name] = own(df, name, **options)
        return tables[name]

    monkeypatch.setattr(packing, "stored", recorded)
    held = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    monkeypatch.setattr(session, "RUNTIME_SETTINGS", session.RUNTIME_SETTINGS | held)
    before = {k: spark.conf.get(k) for k in held}
    try:
        frame = packing.pack_documents(_docs(rows, ["a b", *_mixed(5, 120)] * 3).repartition(9), PATH)
        by_sequence, by_doc = _packed(frame, 2048)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(by_doc) == list(range(363))
    # Tables of so few rows are one file each, whatever the number of partitions before.
    assert {name: len(tables[name].inputFiles()) for name in ("offsets", "placed", "cut")} == {"offsets": 1, "placed": 1, "cut": 1}
    # Many equal lengths: each is counted where it is made, and ranks stay gapless over the tasks.
    ranks = defaultdict(list)
    remainders = tables["pieces"].where("length < 2048")
    for r in packing._ranked(remainders, 363).select("length", "q").collect():
        ranks[r["length"]].append(r["q"])
    assert all(sorted(q) == list(range(len(q))) for q in ranks.values()) and max(map(len, ranks.values())) > 9


def test_patterns_and_least_squares():
    assert sorted(packing.patterns(6, 3)) == [(1, 1, 4), (1, 2, 3), (1, 5), (2, 2, 2), (2, 4), (3, 3), (6,)]
    rng = np.random.default_rng(6)
    for _ in range(20):
        a, b = rng.random((6, 15)), rng.random(6) * 5 - 1
        x = packing.nonnegative_least_squares(a, b)
        slope = a.T @ (a @ x - b)
        # The conditions of an optimum: no way down, and none along the columns in use.
        assert (x >= 0).all() and (slope > -1e-6).all() and np.abs(slope[x > 0]).max(initial=0) < 1e-6


def test_plan_places_each_piece_once_with_little_padding():
    lengths = np.minimum(2047, np.random.default_rng(7).lognormal(6, 1, 50_000).astype(int) + 1)
    histogram = dict(Counter(lengths.tolist()))
    plan = packing.plan_windows(histogram)
    spread = np.repeat(list(histogram), list(histogram.values())).astype(np.int64)
    q = np.concatenate([np.arange(n) for n in histogram.values()])
    found = plan.find(spread, q)
    patterned = (found["at"] < 0).to_numpy()
    filled = np.bincount(found.sequence_id[patterned], spread[patterned], minlength=plan.sequences)
    assert filled.max() <= 2048 and filled.min() > 2048 - 3 * packing.GRID
    assert len(set(zip(found.sequence_id[patterned], found.place[patterned]))) == patterned.sum()
    at = np.sort(found["at"][~patterned].to_numpy())
    order = np.argsort(found["at"][~patterned].to_numpy())
    assert (np.diff(at) == spread[~patterned][order][:-1]).all() and patterned.mean() > 0.5
