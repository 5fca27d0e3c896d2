"""Exact dedup by deterministic block naming, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import BLANKS, id_key, keep_rows, numbered, stored, text_key, whole_text

BLOCK_BYTES = 16384
HASH_BITS = 64


def normalised(column: str = "text") -> Column:
    """The text with each run of white space as one space.

    A single space is already right, so only other runs are matched.
    """
    return F.regexp_replace(whole_text(column), rf"[\x09-\x0D]{BLANKS}*| {BLANKS}+", " ")


def _blocks(docs: DataFrame, id_column: str, text_column: str, block_bytes: int, hash_bits: int) -> DataFrame:
    """One row per fixed-size block: row, doc_id, text_key, text_sha256 (at block 0), n_blocks, pos, block, h."""
    content = F.col("content")
    count = F.greatest(F.lit(1), F.ceil(F.length(content) / block_bytes)).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), F.col("n_blocks") - 1),
        lambda i: F.substring(content, i * block_bytes + 1, F.lit(block_bytes)),
    )
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).alias("doc_id"),
        text_key(text_column).alias("text_key"),
        normalised(text_column).cast("binary").alias("content"),
    ).withColumn("n_blocks", count)
    return rows.select(
        "row", "doc_id", "text_key", "n_blocks", F.sha2(content, 256).alias("text_sha256"), F.posexplode(cut).alias("pos", "block")
    ).select(
        "row", "doc_id", "text_key", "n_blocks", "pos", "block",
        F.when(F.col("pos") == 0, F.col("text_sha256")).alias("text_sha256"),
        F.shiftrightunsigned(F.xxhash64("block"), 64 - hash_bits).alias("h"),
    )


def _name(rows: DataFrame, key: list[str], label: str) -> DataFrame:
    """``rows`` with the integer name of their key: distinct keys, sorted and numbered.

    Keys that occur more than once in a row's group are combined before the shuffle;
    the lookup is a plain join, whose large partitions adaptive execution splits.
    """
    names = numbered(rows.select(*key).distinct(), key, label)
    others = [c for c in rows.columns if c not in key]
    condition = F.lit(True)
    for c in key:
        condition = condition & (rows[c] == names[c])
    return rows.join(names, condition).select(*[rows[c] for c in others], names["name"])


def named_documents(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    block_bytes: int = BLOCK_BYTES, hash_bits: int = HASH_BITS,
) -> DataFrame:
    """One row per document row: row, doc_id, text_key, text_sha256, level, name.

    Two rows have the same (level, name) exactly when their normalised texts are
    equal.  Each text is cut into blocks of ``block_bytes``; distinct blocks are
    sorted and numbered; then adjacent pairs of names are numbered the same way, and
    again, until every document has one name.  Blocks travel once, to be compared in
    full: a block is then known by its hash alone unless different blocks share
    that hash, in which case its bytes are part of its key.  So no hash collision
    can join two texts (``hash_bits`` is lowered in tests to have many).
    """
    blocks = _blocks(docs, id_column, text_column, block_bytes, hash_bits)
    distinct = blocks.groupBy("h", "block").agg(F.lit(1).alias("one"))
    crowded = stored(distinct.groupBy("h").count().where("count > 1").select(F.col("h").alias("shared")), "crowded")
    keyed = blocks.join(crowded, blocks["h"] == crowded["shared"], "left").select(
        "row", "doc_id", "text_key", "n_blocks", "pos", "text_sha256", "h",
        F.when(F.col("shared").isNotNull(), F.col("block")).otherwise(F.lit(b"")).alias("tie"),
    )
    occurrences = stored(keyed, "blocks")
    level = 0
    named = stored(_name(occurrences, ["h", "tie"], "names-0"), "named-0")
    heads = named.where("pos = 0").select("row", "doc_id", "text_key", "text_sha256", "n_blocks", "name")
    done = [heads.where("n_blocks = 1").select("row", "doc_id", "text_key", "text_sha256", F.lit(0).alias("level"), "name")]
    parts = named.where("n_blocks > 1").select("row", "pos", "name", "n_blocks")
    final = None
    while not parts.isEmpty():
        level += 1
        side = F.col("pos") % 2
        pairs = parts.groupBy("row", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
            F.max(F.when(side == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(side == 1, F.col("name"))), F.lit(-1)).alias("right"),
            F.max(F.ceil(F.col("n_blocks") / 2).cast("int")).alias("n_blocks"),
        )
        named_pairs = stored(_name(pairs, ["left", "right"], f"names-{level}"), f"named-{level}")
        finished = named_pairs.where("n_blocks = 1").select("row", F.lit(level).alias("level"), "name")
        final = finished if final is None else final.union(finished)
        parts = named_pairs.where("n_blocks > 1").select("row", "pos", "name", "n_blocks")
    if final is not None:
        long_heads = heads.where("n_blocks > 1").select("row", "doc_id", "text_key", "text_sha256")
        done.append(long_heads.join(final, "row").select("row", "doc_id", "text_key", "text_sha256", "level", "name"))
    return done[0] if len(done) == 1 else done[0].union(done[1])


def exact_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    block_bytes: int = BLOCK_BYTES, hash_bits: int = HASH_BITS,
) -> DataFrame:
    """One row per document row: doc_id, keep_id, group_size, kept, text_sha256, text_key.

    Texts are equal when they agree after white-space runs become one space; null
    is the empty text.  The row with the smallest doc_id stays; a null doc_id comes
    last, so keep_id is null only in groups without any id.  Of rows that repeat the
    same doc_id and text exactly one is kept.  Other columns of ``docs`` are not
    read; an empty table gives no rows.
    """
    named = stored(named_documents(docs, id_column, text_column, block_bytes, hash_bits), "identities")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row"))
    # Written first: the lookup is then a join of two shuffled tables, whose large partitions can be split.
    groups = stored(named.groupBy("level", "name").agg(first.alias("first"), F.count("*").alias("group_size")), "groups")
    on = (named["level"] == groups["level"]) & (named["name"] == groups["name"])
    return named.join(groups, on).select(
        named["doc_id"],
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
        "text_key",
    )


def drop_exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were."""
    kept = exact_duplicates(docs, id_column, text_column).where("kept")
    return keep_rows(docs, kept.withColumn("id_key", id_key()), id_column, text_column)
