"""Exact medians of a growing population, without expanding it per period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def running_median(
    values: DataFrame, buckets: int = 256, approx: bool = False, weight: str | None = None
) -> DataFrame:
    """Median, as of each ``period``, of all values of that or an earlier period.

    ``values`` has (period, value) and may have a whole number ``weight``, how often
    the value counts; the result has one row per period with values.  Joining every value to every later period would multiply the data
    by the number of periods.  Instead the values are counted per quantile
    bucket, which finds the bucket that holds the middle rank of each period,
    and only the values of those buckets are looked at again.  ``approx`` stops
    at the bucket boundary.
    """
    known = values.where(F.col("value").isNotNull() & F.col("period").isNotNull())
    shares = ", ".join(f"{i / buckets!r}D" for i in range(1, buckets))
    boundaries = known.agg(
        F.expr(f"percentile_approx(value, array({shares}), 10000)")
    ).scalar()
    times = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counted = (
        known.groupBy("period", "value").agg(times.alias("n"))
        .withColumn("cuts", boundaries)
        .withColumn("bucket", F.expr("size(filter(cuts, c -> c <= value))"))
    )

    # Bucket x period counts: (buckets x periods) rows, whatever the data size.
    per_cell = counted.groupBy("period", "bucket").agg(F.sum("n").alias("n"))
    grid = counted.select("period").distinct().select(
        "period", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket")
    )
    over_time = W.partitionBy("bucket").orderBy("period").rowsBetween(W.unboundedPreceding, 0)
    over_buckets = W.partitionBy("period").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    cells = (
        grid.join(per_cell, ["period", "bucket"], "left")
        .select("period", "bucket", F.sum(F.coalesce("n", F.lit(0))).over(over_time).alias("n"))
        .select(
            "period", "bucket", "n", F.sum("n").over(over_buckets).alias("upto"),
            F.sum("n").over(W.partitionBy("period")).alias("total"),
        )
        .selectExpr(
            "period", "bucket", "n", "upto", "upto - n AS before",
            "(total + 1) DIV 2 AS low_rank", "(total + 2) DIV 2 AS high_rank",
        )
    )
    # At most two buckets per period hold the middle ranks.
    targets = cells.where("n > 0 AND before < high_rank AND upto >= low_rank").drop("n", "upto")

    if approx:
        lower = targets.groupBy("period").agg(F.min("bucket").alias("bucket"))
        edge = F.expr("get(cuts, greatest(bucket - 1, 0))")
        return lower.withColumn("cuts", boundaries).select("period", edge.alias("median"))

    running = W.partitionBy("period", "bucket").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    added = counted.select(F.col("period").alias("added"), "bucket", "value", "n")
    middle = (
        added.join(F.broadcast(targets), "bucket")
        .where("added <= period")
        .groupBy("period", "bucket", "before", "low_rank", "high_rank", "value")
        .agg(F.sum("n").alias("n"))
        .withColumn("upto", F.col("before") + F.sum("n").over(running))
    )

    def value_at(rank: str):
        return F.expr(f"max(CASE WHEN upto - n < {rank} AND {rank} <= upto THEN value END)")

    return middle.groupBy("period").agg(
        ((value_at("low_rank") + value_at("high_rank")) / 2).alias("median")
    )
