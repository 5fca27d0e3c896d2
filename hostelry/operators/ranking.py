"""Top-k, latest-period and pivot operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, group: str, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of each group; Spark prunes to n per task before the shuffle."""
    rank = F.row_number().over(W.partitionBy(group).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def latest_top_k(df: DataFrame, period: str, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of the latest period, in one pass.

    The k rows that lead the (period desc, order) sort contain the answer, so a
    distributed top-k replaces a separate scan for the latest period.
    """
    head = df.where(F.col(period).isNotNull()).orderBy(F.col(period).desc(), *order).limit(k)
    newest = F.max(period).over(W.partitionBy())  # over at most k rows
    return head.withColumn("_newest", newest).where(F.col(period) == F.col("_newest")).drop("_newest")


def first_rows(df: DataFrame, order: Sequence[Column | str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order, so that the answer is repeatable."""
    return df.orderBy(*order).limit(n)


def top_totals(df: DataFrame, key: str, value: str, k: int) -> DataFrame:
    """The ``k`` keys with the largest summed value, ties by key; a missing key is none."""
    totals = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum(value).alias("total"))
    return totals.orderBy(F.col("total").desc_nulls_last(), F.col(key)).limit(k)


def keep_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a top-k frame (bounded by k, hence the broadcast)."""
    return df.join(F.broadcast(keys.select(key)), key, "left_semi")


def pivot_unique(df: DataFrame, row: str, column: str, value: str, columns: Sequence) -> DataFrame:
    """Pivot that fails on a repeated (row, column) pair instead of merging it."""
    repeated = F.raise_error(F.lit(f"repeated ({row}, {column}) pair in pivot"))
    cells = df.groupBy(row, column).agg(
        F.when(F.count(F.lit(1)) > 1, repeated).otherwise(F.max(value)).alias(value)
    )
    return cells.groupBy(row).pivot(column, list(columns)).agg(F.first(value))
