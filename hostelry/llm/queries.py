"""The registered queries of this folder: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .base import table
from .bpe_codec import codec_digests
from .embedding_dedup import embedding_duplicates
from .exact_dedup import exact_duplicates
from .language_id import language_id
from .line_dedup import line_dedup
from .packing import pack_documents
from .periodic_runs import periodic_runs
from .piecewise_hash import edit_likeness
from .simhash import near_duplicates
from .suffix_dedup import remove_repeats
from .token_alignment import align_tokens
from .token_counts import token_counts
from .toxicity import toxicity

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), VOCABULARY)


def op3_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_duplicates(table(spark, folder, "embeddings"))


def op4_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    return codec_digests(table(spark, folder, "documents"), VOCABULARY)


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents")).drop("id_key", "text_key")


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id(table(spark, folder, "documents"))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), VOCABULARY)


def op9_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup(table(spark, folder, "documents")).drop("kept_text")


def op11_piecewise_hash(spark: SparkSession, folder: str) -> DataFrame:
    return edit_likeness(table(spark, folder, "documents"))


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align_tokens(table(spark, folder, "documents"), VOCABULARY, PIECES)


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs(table(spark, folder, "documents"), planted=True)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = [
        op1_exact_dedup, op2_packing, op3_embedding_dedup, op4_bpe_codec, op5_suffix_dedup,
        op6_toxicity, op7_language_id, op8_token_counts, op9_simhash_dedup, op10_line_dedup,
        op11_piecewise_hash, op12_token_alignment, op13_periodic_runs,
    ]
    return {f.__name__: f for f in listed}


ORACLE = {
    "op1_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
        )
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
        FROM n WINDOW g AS (PARTITION BY t)
    """,
    "op3_embedding_dedup": """
        WITH RECURSIVE fit AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.vec_id AS u, b.vec_id AS v FROM fit a JOIN fit b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98
        ), reach AS (
            SELECT vec_id AS u, vec_id AS v FROM embeddings
            UNION SELECT reach.u, links.v FROM reach JOIN links ON links.u = reach.v
        )
        SELECT vec_id, (SELECT count(*) FROM links WHERE links.u = vec_id) AS n_links,
               (SELECT min(v) FROM reach WHERE reach.u = vec_id) AS component_id,
               vec_id = (SELECT min(v) FROM reach WHERE reach.u = vec_id) AS kept
        FROM embeddings
    """,
    "op10_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, i, split[i] AS line,
                   translate(trim(split[i], E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS key
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS split FROM documents),
                 unnest(range(1, len(split) + 1)) AS r(i)
        ), repeated AS (
            SELECT key, max(doc_id) AS holder FROM lines WHERE length(key) >= 40
            GROUP BY key HAVING count(DISTINCT doc_id) >= 5
        ), judged AS (
            SELECT doc_id, i, line, holder IS NOT NULL AND holder <> doc_id AS dropped
            FROM lines LEFT JOIN repeated USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
        FROM judged GROUP BY doc_id
    """,
}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL with the same rows, for the operators that SQL can express."""
    return dict(ORACLE)
