"""Declared constraints as jobs, and a frame profile.

Every check returns (check, column, violations, rows) for one table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import Table
from .census import census
from .quantiles import QUARTILES, first_pass, numeric_columns, quantiles_of

_COLUMNS = ("check", "column", "violations", "rows")


def _column_checks(df: DataFrame, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """All conditions in one aggregate over one scan."""
    entries = [
        F.struct(
            F.lit(check).alias("check"), F.lit(name).alias("column"),
            F.count_if(broken).alias("violations"),
        )
        for check, name, broken in checks
    ]
    one_row = df.agg(F.array(*entries).alias("entries"), F.count(F.lit(1)).alias("rows"))
    return one_row.select("rows", F.inline("entries")).select(*_COLUMNS)


def not_null_checks(columns: Sequence[str]) -> list[tuple[str, str, Column]]:
    return [("not_null", c, F.col(c).isNull()) for c in columns]


def length_checks(limits: Mapping[str, int]) -> list[tuple[str, str, Column]]:
    return [("max_length", c, F.octet_length(F.col(c)) > n) for c, n in limits.items()]


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _column_checks(df, not_null_checks(columns))


def max_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    return _column_checks(df, length_checks(limits))


def duplicate_keys(df: DataFrame, keys: Sequence[str], ignore_nulls: bool = False) -> DataFrame:
    """Key values held by more than one row, with the number of rows."""
    if ignore_nulls:
        df = df.dropna(subset=list(keys))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def unique_key(df: DataFrame, keys: Sequence[str], check: str = "primary_key") -> DataFrame:
    """Rows beyond the first of each key; nulls are allowed for ``unique``."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    extra = F.when(F.col("n") > 1, F.col("n") - 1).otherwise(0)
    if check == "unique":
        known = F.lit(True)
        for key in keys:
            known = known & F.col(key).isNotNull()
        extra = F.when(known, extra).otherwise(0)
    return per_key.agg(
        F.lit(check).alias("check"), F.lit(",".join(keys)).alias("column"),
        F.coalesce(F.sum(extra), F.lit(0)).alias("violations"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Foreign keys without a parent row, with the number of child rows.

    Child rows are counted per key first: a popular key crosses the shuffle as
    one row per task.
    """
    per_key = child.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return per_key.join(parent.select(F.col(key).alias(column)).distinct(), column, "left_anti")


def foreign_key(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    per_key = child.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    # Grouped first: a parent key that is itself duplicated must not multiply.  It is the
    # grouping of the parent's own key check, count included, so its shuffle is reused.
    grouped = parent.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    known = grouped.select(F.col(key).alias("_parent"))
    matched = per_key.join(known, per_key[column] == known["_parent"], "left")
    lost = F.when(F.col(column).isNotNull() & F.col("_parent").isNull(), F.col("n")).otherwise(0)
    return matched.agg(
        F.lit("foreign_key").alias("check"), F.lit(column).alias("column"),
        F.coalesce(F.sum(lost), F.lit(0)).alias("violations"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
    )


def check_table(df: DataFrame, table: Table, parents: Mapping[str, DataFrame]) -> DataFrame:
    """All declared constraints of one table."""
    result = _column_checks(df, not_null_checks(table.required) + length_checks(table.text_limits))
    result = result.unionByName(unique_key(df, table.key))
    for column in table.unique:
        result = result.unionByName(unique_key(df, [column], "unique"))
    for column, (parent, key) in table.parents.items():
        if parent in parents:
            result = result.unionByName(foreign_key(df, column, parents[parent], key))
    return result.select(F.lit(table.name).alias("table"), *_COLUMNS)


def report(
    frames: Mapping[str, DataFrame], tables: Mapping[str, Table],
    thresholds: Mapping[str, float] | None = None, default_threshold: float = 0.0,
) -> DataFrame:
    """One row per check: violations, rate and whether the threshold holds; each table is scanned once."""
    result = census(frames, tables)
    limit = F.lit(float(default_threshold))
    for check, value in (thresholds or {}).items():
        limit = F.when(F.col("check") == check, F.lit(float(value))).otherwise(limit)
    rate = F.when(F.col("rows") > 0, F.col("violations") / F.col("rows")).otherwise(F.lit(0.0))
    return (
        result.withColumn("rate", rate)
        .withColumn("threshold", limit)
        .withColumn("passed", F.col("rate") <= F.col("threshold"))
    )


def profile(df: DataFrame) -> DataFrame:
    """Column, type and non-null count, in column order, from one scan."""
    entries = [
        F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.count(F.col(f.name)).alias("non_null"),
        )
        for i, f in enumerate(df.schema, start=1)
    ]
    one_row = df.agg(F.array(*entries).alias("entries"), F.count(F.lit(1)).alias("rows"))
    return one_row.select("rows", F.inline("entries")).select(
        "position", "column", "type", "non_null", "rows"
    )


def numeric_summary(df: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per numeric column.

    Two passes: the first one's single row, also a bound for the ranges in which the second
    looks for the quartiles, is read to the driver.  NaN counts as missing; a column
    without values has nulls.
    """
    stats = first_pass(df, numeric_columns(df))
    entries = [
        F.struct(
            F.lit(s.name).alias("column"), F.lit(s.n).cast("long").alias("n"),
            *[F.lit(getattr(s, c)).cast("double").alias(c) for c in ("mean", "std", "min", "max")],
        )
        for s in stats
    ]
    if not entries:
        return df.sparkSession.range(0).selectExpr(
            "'' AS column", "0L AS n", *[f"0D AS {c}" for c in ("mean", "std", "min", "max", "p25", "p50", "p75")]
        )
    known = df.sparkSession.range(1).select(F.inline(F.array(*entries)))
    quartiles = quantiles_of(df, stats).groupBy("column").agg(
        *[F.max(F.when(F.col("share") == q, F.col("value"))).alias(f"p{q * 100:.0f}") for q in QUARTILES]
    )
    return known.join(quartiles, "column", "left").select("column", "n", "mean", "std", "min", "max", "p25", "p50", "p75")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))
