"""The daily KPI row."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import count_where, money_avg, money_sum
from ..functions.columns import as_of_literal, guarded_ratio

CONFIRMED = "confirmed"


def listing_kpis(apartments: DataFrame) -> DataFrame:
    price = F.col("price_usd")
    return apartments.agg(
        F.count("id").alias("total_listings"),
        count_where(F.col("is_active")).alias("active_listings"),
        money_avg(price).alias("avg_price"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.avg("days_since_listing").alias("avg_days_listed"),
    )


def viewing_kpis(viewings: DataFrame, distinct_users: bool = False) -> DataFrame:
    """``total_users`` counts rows with a user.  The number of different users is
    separate and optional: it is the only KPI that needs a shuffle."""
    duration = F.col("viewing_duration_seconds")
    aggregates = [
        F.count(F.lit(1)).alias("total_viewings"),
        count_where(F.col("is_wishlisted")).alias("total_wishlisted"),
        F.count("user_id").alias("total_users"),
        F.count(duration).alias("total_timed_viewings"),
        F.avg(duration).alias("avg_viewing_duration"),
    ]
    if distinct_users:
        aggregates.append(F.countDistinct("user_id").alias("distinct_users"))
    return viewings.agg(*aggregates)


def booking_kpis(bookings: DataFrame) -> DataFrame:
    total = F.col("total_price")
    return bookings.agg(
        F.count(F.lit(1)).alias("total_bookings"),
        count_where(F.col("booking_status") == CONFIRMED).alias("confirmed_bookings"),
        money_avg(total).alias("avg_booking_value"),
        money_sum(total).alias("total_booking_value"),
        F.avg("booking_duration_days").alias("avg_booking_duration"),
    )


def _side_by_side(frames: list[DataFrame]) -> DataFrame:
    """One-row frames as one row.  Stacked and folded: no join is needed."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def presentation_metrics(
    apartments: DataFrame, viewings: DataFrame, bookings: DataFrame, as_of: datetime,
    distinct_users: bool = False,
) -> DataFrame:
    """KPI row of the three enriched tables; rates are fractions 0..1."""
    now = as_of_literal(as_of)
    row = _side_by_side(
        [listing_kpis(apartments), viewing_kpis(viewings, distinct_users), booking_kpis(bookings)]
    )
    viewed = F.col("total_viewings")
    return row.withColumns(
        {
            "booking_conversion_rate": guarded_ratio(F.col("total_bookings"), viewed),
            "wishlist_rate": guarded_ratio(F.col("total_wishlisted"), viewed),
            "avg_viewings_per_listing": guarded_ratio(viewed, F.col("active_listings")),
            "generated_at": now,
            "metrics_date": F.to_date(now),
        }
    )
