"""Exact quantiles of many columns by distributed selection of ranks.

One pass takes counts and a sketch of every column; the sketch encloses each wanted rank
in a narrow range of values.  The next pass counts what lies below, between and above
the ranges and the different values inside them, all columns in one shuffle of
partial counts.  Where a range would still hold very many rows, further passes narrow
it first.  Only one row per column, with the ends of its ranges, reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUARTILES = (0.25, 0.5, 0.75)
ACCURACY = 10_000  # the sketch misses a rank by at most one part in so many
ROWS_AT_ONCE = 2_000_000  # rows of one range whose values are counted
SMALL = 100_000  # columns of no more rows need no range
_GRID = 250  # points of a narrowing sketch


@dataclass
class _Range:
    """Values from ``low`` to ``high`` hold the rank of ``share``; ``rows`` is an estimate from above."""

    share: float
    low: float
    high: float
    rows: float


@dataclass
class ColumnStats:
    """What the first pass knows of a column."""

    name: str
    n: int
    mean: float | None
    std: float | None
    min: float | None
    max: float | None
    ranges: list[_Range] = field(default_factory=list)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def _value(name: str) -> Column:
    """The column as a double; NaN counts as missing."""
    return F.nanvl(F.col(f"`{name}`").cast("double"), F.lit(None).cast("double"))


def first_pass(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float] = QUARTILES,
    accuracy: int = ACCURACY, small: int = SMALL,
) -> list[ColumnStats]:
    """Count, mean, deviation and extremes of each column, and a range around each share."""
    if not columns:
        return []
    margin = 2 / accuracy
    around = [min(1.0, max(0.0, q + d)) for q in shares for d in (-margin, margin)]
    stats = []
    for i, name in enumerate(columns):
        v = _value(name)
        stats.append(F.struct(
            F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
            F.min(v).alias("min"), F.max(v).alias("max"), F.percentile_approx(v, around, accuracy).alias("near"),
        ).alias(f"c{i}"))
    row = df.agg(*stats).first()
    out = []
    for i, name in enumerate(columns):
        s = row[f"c{i}"]
        found = ColumnStats(name, s["n"], s["mean"], s["std"], s["min"], s["max"])
        for k, share in enumerate(shares if s["n"] else ()):
            whole = s["n"] <= max(small, 2 * accuracy)  # the margin must hold a few rows
            low = s["min"] if whole or around[2 * k] <= margin else s["near"][2 * k]
            high = s["max"] if whole or around[2 * k + 1] >= 1 - margin else s["near"][2 * k + 1]
            found.ranges.append(_Range(share, low, high, s["n"] if whole else 3 * margin * s["n"]))
        out.append(found)
    return out


def _inside(name: str, range_: _Range) -> Column:
    v = _value(name)
    return (v >= range_.low) & (v <= range_.high)


def _narrow(df: DataFrame, stats: list[ColumnStats], accuracy: int, rows_at_once: int) -> None:
    """Narrow the ranges that hold too many rows; a range of one value needs no more."""
    while True:
        wide = [(s, r) for s in stats for r in s.ranges if r.rows > rows_at_once and r.low < r.high]
        if not wide:
            return
        grid = [i / _GRID for i in range(_GRID + 1)]
        row = df.agg(*[
            F.struct(
                F.count_if(_value(s.name) < r.low).alias("before"), F.count_if(_inside(s.name, r)).alias("rows"),
                F.percentile_approx(F.when(_inside(s.name, r), _value(s.name)), grid, accuracy).alias("grid"),
            ).alias(f"r{i}") for i, (s, r) in enumerate(wide)
        ]).first()
        for i, (s, r) in enumerate(wide):
            found = row[f"r{i}"]
            rank = r.share * (s.n - 1) - found["before"]
            first = math.floor((rank - 1) / found["rows"] * _GRID - 2 * _GRID / accuracy) - 1
            last = math.ceil((rank + 2) / found["rows"] * _GRID + 2 * _GRID / accuracy) + 1
            low = r.low if first <= 0 else found["grid"][first]
            high = r.high if last >= _GRID else found["grid"][last]
            # Where a sketch tells no more apart, few different values hold the rows.
            r.rows = 0 if (low, high) == (r.low, r.high) else found["rows"] * (last - first + 2) / _GRID
            r.low, r.high = low, high


def _segment(name: str, ranges: list[_Range]) -> Column:
    """The number of range ends up to the value: odd inside a range, even between two."""
    v, out = _value(name), F.lit(0)
    merged: list[list[float]] = []
    for r in sorted(ranges, key=lambda r: (r.low, r.high)):
        if merged and r.low <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], r.high)
        else:
            merged.append([r.low, r.high])
    for low, high in merged:
        out = out + (v >= low).cast("int") + (v > high).cast("int")
    return out


def quantiles_of(
    df: DataFrame, stats: list[ColumnStats], accuracy: int = ACCURACY, rows_at_once: int = ROWS_AT_ONCE,
) -> DataFrame:
    """(column, share, value): the interpolated quantiles of the columns of ``first_pass``.

    The value at place share * (n - 1) of the sorted values, linear between two of them.
    """
    _narrow(df, stats, accuracy, rows_at_once)
    used = [s for s in stats if s.ranges]
    cells, targets = [], []
    for s in used:
        segment = _segment(s.name, s.ranges)
        inside = F.when(segment % 2 == 1, _value(s.name))
        cells.append(F.struct(F.lit(s.name).alias("column"), _value(s.name).isNotNull().alias("known"), segment.alias("segment"), inside.alias("value")))
        for r in s.ranges:
            place = r.share * (s.n - 1)
            targets.append(F.struct(
                F.lit(s.name).alias("name"), F.lit(r.share).alias("share"), F.lit(math.floor(place)).cast("long").alias("low"),
                F.lit(math.ceil(place)).cast("long").alias("high"), F.lit(place - math.floor(place)).alias("part"),
            ))
    if not used:
        return df.sparkSession.range(0).selectExpr("'' AS column", "0D AS share", "0D AS value")
    counted = (
        df.select(F.inline(F.array(*cells))).where("known")
        .groupBy("column", "segment", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    # One row per different value inside the ranges, and one per segment outside.
    ordered = W.partitionBy("column").orderBy("segment", "value").rowsBetween(W.unboundedPreceding, 0)
    placed = counted.withColumn("upto", F.sum("n").over(ordered)).withColumn(
        "target", F.explode(F.filter(F.array(*targets), lambda t: t["name"] == F.col("column")))
    )

    def value_at(rank: str) -> Column:
        held = (F.col("upto") - F.col("n") <= F.col(f"target.{rank}")) & (F.col(f"target.{rank}") < F.col("upto"))
        return F.max(F.when(held, F.col("value")))

    found = placed.groupBy("column", F.col("target.share").alias("share"), F.col("target.part").alias("part")).agg(
        value_at("low").alias("low"), value_at("high").alias("high")
    )
    outside = F.raise_error(F.lit("a rank lies outside the range of its sketch"))
    value = F.col("low") + (F.col("high") - F.col("low")) * F.col("part")
    return found.select("column", "share", F.when(F.col("low").isNull() | F.col("high").isNull(), outside).otherwise(value).alias("value"))


def exact_quantiles(
    df: DataFrame, columns: Sequence[str] | None = None, shares: Sequence[float] = QUARTILES,
    accuracy: int = ACCURACY, rows_at_once: int = ROWS_AT_ONCE, small: int = SMALL,
) -> DataFrame:
    """(column, share, value) of numeric columns, exact and interpolated; columns without values give no rows."""
    stats = first_pass(df, numeric_columns(df) if columns is None else columns, shares, accuracy, small)
    return quantiles_of(df, stats, accuracy, rows_at_once)
