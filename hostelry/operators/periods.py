"""Calendar operators: look-back, spine, booked nights."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_of_literal, period_end, period_start, period_step


def lookback(df: DataFrame, at: str, as_of: datetime, days: int) -> DataFrame:
    """Rows with ``as_of - days <= at < as_of + 1 day``; literals reach the scan."""
    return df.where(
        (F.col(at) >= as_of_literal(as_of - timedelta(days=days)))
        & (F.col(at) < as_of_literal(as_of + timedelta(days=1)))
    )


def latest(df: DataFrame, value: Column) -> Column:
    """The largest ``value`` of ``df`` as a literal.

    One row is read to the driver: as a literal, unlike as a subquery, the bound
    reaches the statistics of stored files, which then skip what lies before it.
    """
    return F.lit(df.agg(F.max(value).alias("newest")).first()["newest"])


def period_spine(bounds: DataFrame, grain: str = "week") -> DataFrame:
    """Every period start from ``first`` to ``last`` of a one-row frame."""
    ends = F.greatest("first", "last")
    return bounds.select(
        F.explode(F.sequence(F.col("first"), ends, period_step(grain))).alias("period")
    )


def with_stay(bookings: DataFrame) -> DataFrame:
    """Keep bookings with at least one night; adds ``checkin`` and ``checkout`` days."""
    days = bookings.withColumns(
        {"checkin": F.to_date("checkin_date"), "checkout": F.to_date("checkout_date")}
    )
    return days.where(F.col("checkout") > F.col("checkin"))


def booked_nights(bookings: DataFrame) -> DataFrame:
    """Distinct (apartment, night) pairs; the checkout day is not a night."""
    nights = F.sequence(F.col("checkin"), F.date_sub("checkout", 1), F.expr("interval 1 day"))
    return (
        with_stay(bookings)
        .select("apartment_id", F.explode(nights).alias("night"))
        .distinct()
    )


def stay_masks(bookings: DataFrame, grain: str = "week", week_start: str = "MON") -> DataFrame:
    """One row per stay and touched period, with the booked nights as a bit mask.

    Bit i stands for the i-th day of the period.  OR-ing the masks of a listing
    gives its distinct nights, so overlapping stays collapse in the map-side
    aggregate and no night is ever shuffled on its own.
    """
    first = period_start(F.col("checkin"), grain, week_start)
    last = period_start(F.date_sub("checkout", 1), grain, week_start)
    start = F.col("period")
    length = F.datediff(period_end(start, grain), start)
    lo = F.greatest(F.datediff("checkin", start), F.lit(0))
    hi = F.least(F.datediff("checkout", start), length)

    def low_bits(n: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), n) - F.lit(1).cast("long")

    return (
        with_stay(bookings)
        .select("apartment_id", "checkin", "checkout",
                F.explode(F.sequence(first, last, period_step(grain))).alias("period"))
        .select("apartment_id", "period", (low_bits(hi) - low_bits(lo)).alias("mask"))
    )


def nights_per_period(
    bookings: DataFrame, grain: str = "week", week_start: str = "MON"
) -> DataFrame:
    """Distinct booked nights per (listing, period)."""
    return (
        stay_masks(bookings, grain, week_start)
        .groupBy("apartment_id", "period")
        .agg(F.bit_count(F.bit_or("mask")).cast("long").alias("nights"))
    )
