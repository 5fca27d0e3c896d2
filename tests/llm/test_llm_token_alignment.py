"""Cross-tokenizer alignment against a plain loop over all documents and token pairs."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from hostelry.llm import token_alignment as T

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, chunk long, radix string, head int, n_a int"


def _letters():
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _brute(texts):
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = _letters()

    def spans(pieces):
        out, at = [], 0
        for piece in pieces:
            out.append((at, at + len(piece)))
            at += len(piece)
        return out

    docs, held = [], Counter()
    for text in texts:
        text = text or ""
        a = library.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in library.id_to_token(i)) for i in a]
        bytes_b = []
        for i in b:
            piece = model.id_to_piece(i)
            bytes_b.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            a, b, bytes_a, bytes_b = [], [], [], []
        at_a, at_b = spans(bytes_a), spans(bytes_b)
        links, j = [], 0
        for x, (s, e) in zip(a, at_a):
            while j < len(b) and at_b[j][1] <= s:
                j += 1
            k = j
            while k < len(b) and at_b[k][0] < e:
                links.append((x, b[k]))
                k += 1
        both = {e for _, e in at_a} & {e for _, e in at_b}
        sides = []
        for ids, at in ((a, at_a), (b, at_b)):
            cut = [[]]
            for i, (_, e) in zip(ids, at):
                cut[-1].append(str(i))
                if e in both:
                    cut.append([])
            sides.append([",".join(g) for g in cut[:-1]])
        groups = [f"{x}|{y}" for x, y in zip(*sides)]
        docs.append((a, b, groups, links))
        held.update(set(links))
    top = {}
    for (a, _), n in held.items():
        top[a] = max(top.get(a, 0), n)
    return [
        (len(a), len(b), len(groups), len(links), sum(held[x] == top[x[0]] for x in links), sum(held[x] for x in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "")
        for a, b, groups, links in docs
    ]


def _texts(seed, count):
    rng = random.Random(seed)
    words = ["the", "of", "naïve", "straße", "日本語", "don't", "I'll", "12345", "😀", "▁", "<|endoftext|>", "<s>", "<0x41>", "x" * 30,
             "antidisestablishmentarianism", "foo_bar", "http://a.b/c", "--", "\n\n", "\t", "  ", "İ", "ﬁ", " ", "é", "१२"]
    common = ["and", "this", "is", "a", "text", "with", "words", ",", "."]
    return ["".join(rng.choice([" ", " ", "", "\n"]) + rng.choice(words if rng.random() < 0.2 else common) for _ in range(rng.randrange(1, 60)))
            for _ in range(count)]


ODD = ["", None, " ", "\n", "a", " leading", "trailing ", "two  spaces", "▁", "<|endoftext|>", "\x00 nul", "​", "🏳️‍🌈", "a" * 5000, "�"]


@pytest.mark.parametrize("radix, fan_in, chunk_bytes, parts", [(32, 64, 1 << 22, 3), (5, 2, 300, 4), (1, 3, 1, 2)])
def test_rows_equal_a_plain_loop(rows, radix, fan_in, chunk_bytes, parts):
    texts = _texts(radix, 60) + ODD
    docs = rows(SCHEMA, *[(i, t, 1, "x", 2, 3) for i, t in enumerate(texts)]).repartition(parts)
    found = T.align_tokens(docs, A, B, radix=radix, fan_in=fan_in, chunk_bytes=chunk_bytes)
    got = {r["doc_id"]: tuple(r)[1:] for r in found.collect()}
    assert [got[i] for i in range(len(texts))] == _brute(texts)


def test_repeated_rows_and_null_ids_are_documents_of_their_own(rows):
    texts = ["the same text"] * 40 + ["another text", "the text"]
    docs = rows(SCHEMA, *[(None if i % 2 else 7, t, 1, "x", 2, 3) for i, t in enumerate(texts)])
    found = sorted(tuple(r)[1:] for r in T.align_tokens(docs, A, B, chunk_bytes=60).collect())
    assert found == sorted(_brute(texts))


def test_empty_table_and_table_without_tokens(rows):
    assert T.align_tokens(rows(SCHEMA), A, B).collect() == []
    found = T.align_tokens(rows(SCHEMA, (1, None, 1, "x", 2, 3), (2, "", 1, "x", 2, 3)), A, B).collect()
    assert sorted(tuple(r) for r in found) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_a_text_above_a_megabyte(rows):
    texts = ["word " * 260_000 + "end", "word end"]
    docs = rows(SCHEMA, *[(i, t, 1, "x", 2, 3) for i, t in enumerate(texts)])
    found = {r["doc_id"]: tuple(r)[1:] for r in T.align_tokens(docs, A, B).collect()}
    assert [found[0], found[1]] == _brute(texts)


def test_runs_are_read_in_blocks_and_merged_by_code(monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 7)
    rng = np.random.default_rng(1)
    runs = [np.unique(rng.integers(0, 200, 90)) for _ in range(9)] + [np.empty(0, np.int64)]
    counts = [rng.integers(1, 2**40, len(r)) for r in runs]
    heads = [T.write_run(r, c) for r, c in zip(runs, counts)]
    assert max(len(block[0]) for head in heads for block in T.read_run(head)) == 7
    wanted = Counter()
    for r, c in zip(runs, counts):
        wanted.update(dict(zip(r.tolist(), c.tolist())))
    blocks = list(T.read_run(T.merge_runs(heads)))
    merged = dict(zip(np.concatenate([b[0] for b in blocks]).tolist(), np.concatenate([b[1] for b in blocks]).tolist()))
    assert merged == dict(wanted) and list(merged) == sorted(merged)
    codes, sums, highest = T.finished(T.merge_runs(heads), 20)
    assert sorted(codes[highest].tolist()) == sorted(
        c for c in wanted if wanted[c] == max(wanted[d] for d in wanted if d // 20 == c // 20))
