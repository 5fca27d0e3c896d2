"""The registered queries against their SQL, and the pipeline stage by stage."""

import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from hostelry.llm import queries as llm
from hostelry.llm.base import table

SMALL = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert set(llm.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    duck.execute(f"CREATE VIEW checked AS {llm.oracle_sql()[name]}")
    result = duck.execute("SELECT * FROM checked")
    names = sorted(c[0] for c in result.description)
    place = {c[0]: i for i, c in enumerate(result.description)}
    expected = sorted(tuple(r[place[n]] for n in names) for r in result.fetchall())
    df = llm.queries()[name](spark, SMALL)
    assert sorted(df.columns) == names
    assert sorted(tuple(r[n] for n in names) for r in df.collect()) == expected


def _pandas(df):
    return df.toPandas().sort_values("doc_id").reset_index(drop=True)


def test_stages_by_brute_force(spark):
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before, docs = _pandas(docs), stage(spark, docs, SMALL)
        if name != "packing":
            assert docs.columns == columns
        after = _pandas(docs)
        if name != "packing":
            docs = spark.createDataFrame(after, table(spark, SMALL, "documents").schema)
        if name == "toxicity":
            told = pd.read_parquet(f"{SMALL}/labels.parquet").set_index("doc_id").toxic
            clean = [i for i in before.doc_id if told.get(i) == 0]
            assert np.isin(clean, after.doc_id).mean() > 0.95
            rejected = set(before.doc_id) - set(after.doc_id)
            assert after.equals(before[~before.doc_id.isin(rejected)].reset_index(drop=True))
        elif name == "exact_dedup":
            normal = before.text.str.replace(r"[\x20\x09-\x0D]+", " ", regex=True)
            assert after.equals(before[~normal.duplicated()].reset_index(drop=True))
        elif name == "simhash_dedup":
            from test_llm_exact_and_simhash import _fingerprint, _reach

            prints = [_fingerprint(t) for t in before.text]
            near = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
            first = [i for i, least in enumerate(_reach(len(prints), near)) if i == least]
            assert after.equals(before.iloc[first].reset_index(drop=True))
        elif name == "suffix_dedup":
            seen, size = {}, corpus_pipeline.PASSAGE_BYTES
            for i, t in zip(before.doc_id, before.text):
                data = t.encode()
                for p in range(len(data) - size + 1):
                    seen.setdefault(data[p : p + size], []).append((i, p))
            gone = {i: np.zeros(len(t.encode()), bool) for i, t in zip(before.doc_id, before.text)}
            for places in seen.values():
                for i, p in places if len(places) > 1 else []:
                    gone[i][p : p + size] = True
            left = [np.frombuffer(t.encode(), np.uint8)[~gone[i]].tobytes().decode(errors="ignore") for i, t in zip(before.doc_id, before.text)]
            assert after.text.tolist() == left and after.n_chars.tolist() == [len(t) for t in left]
            assert after.doc_id.tolist() == before.doc_id.tolist()
        else:
            library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            for i, t in zip(before.doc_id, before.text):
                ids = np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4")
                rows = after[after.doc_id == i].sort_values("start")
                assert rows.length.sum() == len(ids)
                for r in rows.itertuples():
                    assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
            filled = after.groupby("sequence_id").length.sum()
            assert filled.max() <= 2048 and filled.sum() > 0.95 * 2048 * len(filled)


def test_whole_run(spark):
    packed = corpus_pipeline.run(spark, SMALL)
    assert packed.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert packed.count() > 0


def _folder(spark, tmp_path, docs, labels):
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("count", [0, 1, 30])
def test_run_of_empty_and_tiny_tables(spark, tmp_path, count):
    docs = [(i, f"tiny text {i} of the table, number {i * i} and {i * 7919}", "en", "s", 9) for i in range(count)]
    folder = _folder(spark, tmp_path, docs, [(i, 1, int(i == 3)) for i in range(count)])
    packed = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in packed} == set(range(count))


def test_run_of_odd_rows(spark, tmp_path):
    """Nulls, empty and very long texts, copies and ids that repeat: every different text is packed."""
    docs = [(None, None, None, None, None), (1, "", "x", "s", 0), (2, "same text here", "x", "s", 1), (2, "same text here", "x", "s", 1),
            (3, "same  text\nhere", None, "s", 1), (4, "word " * 260_000, "x", "s", 1), (5, "z" * 300_000, "x", "s", 1), (6, "last of all", "x", "s", 1)]
    packed = corpus_pipeline.run(spark, _folder(spark, tmp_path, docs, [(1, 1, 0), (None, 1, 1), (6, 0, None)])).collect()
    assert {r["doc_id"] for r in packed} == {1, 2, 4, 5, 6}
