"""Bucketed tables that give a key with a large share of the rows several buckets.

A bucket is read by one task.  In a plain bucketed table all rows of a key lie in one bucket, so a key
with a third of the rows makes a task with a third of the work.  Here such keys get a second
bucket column, ``SALT``: the large table's rows of a hot key are dealt over its salts, the small table's
row of that key is repeated for each.  A join on (key, SALT) needs no shuffle and gives the rows of
the join on the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "_salt"


def heavy_keys(df: DataFrame, key: str, buckets: int, share: float | None = None) -> DataFrame:
    """(key, splits) of the keys that hold more than ``share`` of all rows (half a bucket's share unless given).

    Exact: all rows are counted per key.  Fewer than 1 / share keys can pass, so the rows that are
    read to the driver are bounded by that whatever the data.  A key gets a salt for each half
    bucket that it fills.  Null is a key like any other; of an empty table the result is empty.
    """
    share = share or 1 / (2 * buckets)
    counts = df.groupBy(F.col(key)).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    splits = F.ceil(F.col("n") / total * F.lit(2 * buckets)).cast("int")
    heavy = counts.where(F.col("n") > F.lit(share) * total).select(key, splits.alias("splits"))
    heavy = heavy.where("splits > 1")
    return df.sparkSession.createDataFrame(heavy.collect(), heavy.schema)


def _with_splits(df: DataFrame, key: str, heavy: DataFrame) -> DataFrame:
    found = heavy.select(F.col(key).alias("_heavy"), F.col("splits").alias("_splits"))
    return df.join(F.broadcast(found), df[key].eqNullSafe(found["_heavy"]), "left").drop("_heavy")


def salted(df: DataFrame, key: str, heavy: DataFrame) -> DataFrame:
    """The rows with the salt of each, by a hash of the whole row: rows equal in all columns share one.

    Not drawn at random: a task that runs again after a loss must deal its rows as before.
    """
    spread = F.pmod(F.xxhash64(*df.columns), F.col("_splits"))
    salt = F.when(F.col("_splits").isNull(), F.lit(0)).otherwise(spread).cast("int")
    return _with_splits(df, key, heavy).withColumn(SALT, salt).drop("_splits")


def replicated(df: DataFrame, key: str, heavy: DataFrame) -> DataFrame:
    """Each row once for every salt of its key."""
    salts = F.sequence(F.lit(0), F.coalesce("_splits", F.lit(1)) - 1)
    return _with_splits(df, key, heavy).withColumn(SALT, F.explode(salts)).drop("_splits")


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.hash(key, F.col(SALT)), F.lit(buckets))


def write_salted(df: DataFrame, name: str, key: str, buckets: int) -> None:
    """Table of salted or replicated rows, bucketed on (key, SALT); one file per bucket, sorted for merge joins."""
    ready = df.repartition(buckets, _bucket(F.col(key), buckets))
    writer = ready.write.mode("overwrite").format("parquet")
    writer.bucketBy(buckets, key, SALT).sortBy(key, SALT).saveAsTable(name)


def write_pair(large: DataFrame, small: DataFrame, key: str, buckets: int, large_name: str, small_name: str) -> DataFrame:
    """Write both sides; gives the (key, splits) that were used, which both must share."""
    heavy = heavy_keys(large, key, buckets)
    write_salted(salted(large, key, heavy), large_name, key, buckets)
    write_salted(replicated(small, key, heavy), small_name, key, buckets)
    return heavy


def join_salted(large: DataFrame, small: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """The two stored sides on their key; ``inner`` and ``left`` are right, as only the small side repeats rows."""
    if how not in ("inner", "left"):
        raise ValueError("the small side is repeated: only inner and left joins keep its rows once")
    return large.join(small.hint("merge"), [key, SALT], how).drop(SALT)
