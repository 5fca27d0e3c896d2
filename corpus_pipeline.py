"""The corpus pipeline: documents in, packed training sequences out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostelry.llm.base import stored, table
from hostelry.llm.exact_dedup import drop_exact_duplicates
from hostelry.llm.packing import pack_documents
from hostelry.llm.queries import VOCABULARY
from hostelry.llm.simhash import drop_near_duplicates
from hostelry.llm.suffix_dedup import drop_repeats
from hostelry.llm.toxicity import drop_toxic


# A passage of more than 50 words is about 300 bytes long; the shared strings that go are a little shorter.
PASSAGE_BYTES, PASSAGE_GAP = 256, 120


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, trained on their labels, does not reject.

    Null and empty texts are scored as empty; repeated rows stay or go together.  Where
    nothing can be learned (no labels, too few rows) all stay; an empty table stays empty.
    """
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts equal up to white space, the one of least doc_id.

    Null counts as empty; rows without an id stay only where no row of the group has one;
    of rows that repeat id and text one stays; an empty table stays empty.
    """
    return drop_exact_duplicates(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of least doc_id.

    Texts without words, null included, have one fingerprint and so are one group.  Null ids
    and repeated rows are as in the exact stage; an empty table stays empty.
    """
    return drop_near_duplicates(docs)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of PASSAGE_BYTES that occur elsewhere; n_chars counts what is left.

    Null texts stay null with a null n_chars, shorter texts as they are; rows that repeat a
    long text are all emptied; an empty table stays empty.
    """
    return drop_repeats(docs, length=PASSAGE_BYTES, gap=PASSAGE_GAP).withColumn("n_chars", F.length("text").cast("long"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their training sequences.

    A null or empty text is its end token alone; repeated rows are packed each; an empty
    table gives no pieces.
    """
    return pack_documents(docs, VOCABULARY)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("simhash_dedup", simhash_stage),
    ("suffix_dedup", suffix_stage),
    ("packing", packing_stage),
]

# A trained classifier, byte strings and tokens are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``; each result is written and reread by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
