"""Value counts, histogram and kernel density of one numeric column."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, value: str) -> DataFrame:
    """Rows per distinct value and their share of all rows in percent, by value."""
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(
        value, "n", (F.col("n").cast("double") / total * 100).alias("pct")
    ).where(F.col(value).isNotNull()).orderBy(value)


def _counted(df: DataFrame, value: str) -> DataFrame:
    v = F.col(value).cast("double")
    return df.where(v.isNotNull()).groupBy(v.alias("v")).agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed, empty bins kept."""
    counts = _counted(df, value)
    # The sum keeps this subtree equal to the main one, so its shuffle is reused.
    span = counts.agg(
        F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("n").alias("total")).alias("s")
    )
    lo = F.expr("CASE WHEN s.lo = s.hi THEN s.lo - 0.5D ELSE s.lo END").alias("lo")
    hi = F.expr("CASE WHEN s.lo = s.hi THEN s.hi + 0.5D ELSE s.hi END").alias("hi")
    filled = (
        counts.withColumn("s", span.scalar()).select("v", "n", lo, hi)
        .groupBy(F.expr(f"CAST(least(width_bucket(v, lo, hi, {bins}), {bins}) AS INT)").alias("bin"))
        .agg(F.sum("n").alias("filled"))
    )
    # One row per bin from the range itself: empty bins stay visible.
    frame = span.where("s.total IS NOT NULL").select(
        lo, hi, F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin")
    )
    width = (F.col("hi") - F.col("lo")) / bins
    return (
        frame.join(filled, "bin", "left")
        .select(
            "bin",
            (F.col("lo") + width * (F.col("bin") - 1)).alias("bin_start"),
            (F.col("lo") + width * F.col("bin")).alias("bin_end"),
            F.coalesce("filled", F.lit(0)).alias("n"),
        )
        .orderBy("bin")
    )


def gaussian_kde(df: DataFrame, value: str, points: int = 200) -> DataFrame:
    """Density on an even grid over [min, max], Scott bandwidth.

    Equal values are counted first, so the work is (distinct values x points).
    Null density when the bandwidth is 0 or undefined.
    """
    counts = _counted(df, value)
    # Squares are summed about the mean: differences of large sums would lose the spread of large values.
    mean = counts.agg(F.sum(F.col("n") * F.col("v")) / F.sum("n")).scalar()
    off = F.col("v") - F.col("mean")
    stats = counts.withColumn("mean", mean).agg(
        F.struct(
            F.sum("n").alias("total"), F.min("v").alias("lo"), F.max("v").alias("hi"),
            F.sum(F.col("n") * off * off).alias("squares"),
        )
    ).scalar()
    total = F.col("s.total")
    variance = F.try_divide(F.col("s.squares"), total - 1)
    spread = F.sqrt(variance) * F.pow(total.cast("double"), F.lit(-0.2))
    usable = F.when(F.col("s.hi") > F.col("s.lo"), spread)
    step = (F.col("s.hi") - F.col("s.lo")) / (points - 1)
    grid = (
        counts.withColumn("s", stats)
        .select(
            "v", "n", total.alias("total"), usable.alias("h"), F.col("s.lo").alias("lo"),
            step.alias("step"), F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"),
        )
        .withColumn("x", F.col("lo") + F.col("step") * F.col("point"))
    )
    z = F.try_divide(F.col("x") - F.col("v"), F.col("h"))
    kernel = F.sum(F.col("n") * F.exp(-z * z / 2))
    scale = F.col("total") * F.col("h") * math.sqrt(2 * math.pi)
    return (
        grid.groupBy("point", "x", "total", "h").agg(kernel.alias("k"))
        .select("point", "x", F.try_divide(F.col("k"), scale).alias("density"))
        .orderBy("point")
    )


def binned_density(df: DataFrame, value: str, points: int = 200, cells: int = 4096) -> DataFrame:
    """The density of a continuous column from linear binning: (point, x, density).

    Two passes over the values, each folded before its shuffle.  The first gives count, extremes and deviation; in
    the second each value gives its weight to the two nearest of ``cells`` even grid places, in
    proportion to its nearness.  The kernel is then summed over (cells x points) rows, however many values there
    are.  Interpolating the kernel over a grid width d is off by at most d^2 / 8 times its greatest second
    derivative, so every density is within ``binning_error`` of the exact one.  Missing values and
    NaN are left out; the density is null when the bandwidth is 0 or undefined.
    """
    v = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    known = df.select(v.alias("v")).where("v IS NOT NULL")
    stats = known.agg(F.struct(
        F.count("v").alias("total"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.stddev_samp("v").alias("std"),
    )).scalar()
    lo, hi, total = F.col("s.lo"), F.col("s.hi"), F.col("s.total")
    width = (hi - lo) / (cells - 1)
    place = F.try_divide(F.col("v") - lo, width)
    left = F.least(F.floor(F.coalesce(place, F.lit(0.0))), F.lit(cells - 2)).cast("int")
    share = F.coalesce(place, F.lit(0.0)) - F.col("cell")
    binned = (
        known.withColumn("s", stats).select("v", "s", left.alias("cell"))
        .groupBy("cell").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(share).alias("right"))
        .select(F.inline(F.array(
            F.struct("cell", (F.col("n") - F.col("right")).alias("weight")),
            F.struct((F.col("cell") + 1).alias("cell"), F.col("right").alias("weight")),
        )))
        .groupBy("cell").agg(F.sum("weight").alias("weight"))
    )
    h = F.when(hi > lo, F.col("s.std") * F.pow(total.cast("double"), F.lit(-0.2)))
    point = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    grid = (
        binned.withColumn("s", stats)
        .select("weight", total.alias("total"), h.alias("h"), (lo + width * F.col("cell")).alias("v"), lo.alias("lo"),
                ((hi - lo) / (points - 1)).alias("step"), point)
        .withColumn("x", F.col("lo") + F.col("step") * F.col("point"))
    )
    z = F.try_divide(F.col("x") - F.col("v"), F.col("h"))
    scale = F.col("total") * F.col("h") * math.sqrt(2 * math.pi)
    return (
        grid.groupBy("point", "x", "total", "h").agg(F.sum(F.col("weight") * F.exp(-z * z / 2)).alias("k"))
        .select("point", "x", F.try_divide(F.col("k"), scale).alias("density")).orderBy("point")
    )


def binning_error(span: float, bandwidth: float, cells: int = 4096) -> float:
    """The most by which a density of ``binned_density`` differs from the exact one."""
    width = span / (cells - 1)
    return width * width / (8 * bandwidth**3 * math.sqrt(2 * math.pi))
