"""Repeat customers: bookings within a rolling window of days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _days(n: int) -> Column:
    return F.expr(f"interval {int(n)} days")


def rolling_counts(bookings: DataFrame, days: int = 30, chunk: str = "hour") -> DataFrame:
    """Bookings of the same user in ``[t - days, t]``, per (user, booking time).

    The count at t is (bookings up to t) minus (bookings that left the window
    before t).  Both are running sums, so a user's history can be cut into time
    chunks: a window inside each chunk plus the running total of the chunks
    before it.  A user with a large share of all rows is thereby spread over
    many tasks, while the per-user window sees one row per non-empty chunk.
    """
    steps = (
        bookings.where("booking_date IS NOT NULL")
        .select("user_id", F.expr(
            "inline(array(struct(booking_date AS at, 1L AS entered, 0L AS left), "
            f"struct(booking_date + interval {int(days)} days AS at, 0L AS entered, 1L AS left)))"
        ))
        # Filtered and cut before the grouping, so that both uses below share one shuffle.
        .where("at IS NOT NULL")
        .withColumn("chunk", F.date_trunc(chunk, "at"))
        .where("chunk IS NOT NULL")
        .groupBy("user_id", "chunk", "at")
        .agg(F.sum("entered").alias("entered"), F.sum("left").alias("left"))
    )
    inside = W.partitionBy("user_id", "chunk").orderBy("at")
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    before = inside.rowsBetween(W.unboundedPreceding, -1)
    local = steps.select(
        "user_id", "chunk", "at", "entered",
        (F.sum("entered").over(upto) - F.coalesce(F.sum("left").over(before), F.lit(0))).alias("net"),
    ).where(F.col("entered") > 0)
    earlier = W.partitionBy("user_id").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        steps.groupBy("user_id", "chunk")
        .agg(F.sum(F.col("entered") - F.col("left")).alias("net"))
        .select("user_id", "chunk",
                F.coalesce(F.sum("net").over(earlier), F.lit(0)).alias("carried"))
    )
    return local.join(carried, ["user_id", "chunk"]).select(
        "user_id", F.col("at").alias("booking_date"),
        (F.col("net") + F.col("carried")).alias("bookings_in_window"),
    )


def rolling_repeat(bookings: DataFrame, days: int = 30) -> DataFrame:
    """Every booking with its rolling count and repeat flag."""
    counts = rolling_counts(bookings, days)
    return bookings.join(counts, ["user_id", "booking_date"], "left").withColumns(
        {
            "bookings_in_window": F.coalesce("bookings_in_window", F.lit(0)),
            "is_repeat": F.coalesce(F.col("bookings_in_window") > 1, F.lit(False)),
        }
    )


def flag_repeat_days(user_days: DataFrame, days: int = 30) -> DataFrame:
    """Adds ``is_repeat`` to a (user, day) frame with booking counts and times.

    Needs ``bookings``, ``first_booking`` and ``last_booking``.  A day holds a
    repeat booking when it has two bookings, or one that follows the user's
    previous booking within the window.  The per-user window sees one row per
    day, however many bookings the user has.
    """
    earlier = W.partitionBy("user_id").orderBy("day").rowsBetween(W.unboundedPreceding, -1)
    previous = F.max("last_booking").over(earlier)
    soon = F.col("first_booking") <= previous + _days(days)
    repeat = (F.col("bookings") > 1) | ((F.col("bookings") == 1) & F.coalesce(soon, F.lit(False)))
    return user_days.withColumn("is_repeat", repeat)
