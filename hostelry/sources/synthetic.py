"""Sample presentation frames for trying the reports without any data.

Weeks and members are exploded from array literals, measures are seeded random
columns.  Integer ranges are half-open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the sample data.
FIRST_SUNDAY = "2023-01-01"
WEEKS = 12
CITIES = ["New York", "Los Angeles", "Chicago", "Miami", "San Francisco"]
STATES = ["NY", "CA", "IL", "FL", "CA"]
LISTINGS_PER_WEEK = 10
USERS = 20
REPEAT_SHARE = 0.3


class _Draw:
    """Seeded random columns; each call uses the next seed."""

    def __init__(self, seed: int):
        self.seed = seed

    def share(self) -> Column:
        self.seed += 1
        return F.rand(self.seed)

    def real(self, lo: float, hi: float) -> Column:
        return F.lit(float(lo)) + self.share() * float(hi - lo)

    def whole(self, lo: int, hi: int) -> Column:
        return (F.lit(lo) + F.floor(self.share() * (hi - lo))).cast("bigint")

    def choice(self, values: list[str]) -> Column:
        options = F.array(*[F.lit(v) for v in values])
        return F.get(options, self.whole(0, len(values)).cast("int"))


def sample_weeks(spark: SparkSession, weeks: int = WEEKS) -> DataFrame:
    first = F.to_date(F.lit(FIRST_SUNDAY))
    days = F.sequence(first, F.date_add(first, 7 * (weeks - 1)), F.expr("interval 7 days"))
    return spark.range(1).select(F.explode(days).alias("week_start_date"))


def weekly_performance(spark: SparkSession, seed: int = 0, weeks: int = WEEKS) -> DataFrame:
    draw = _Draw(seed)
    return sample_weeks(spark, weeks).select(
        "week_start_date",
        draw.real(100, 300).alias("avg_listing_price"),
        draw.real(80, 250).alias("median_listing_price"),
        draw.whole(100, 500).alias("total_active_listings"),
        draw.whole(10, 50).alias("new_listings"),
        draw.real(40, 90).alias("occupancy_rate"),
        draw.real(1, 5).alias("avg_price_per_sqft"),
    )


def popular_locations(spark: SparkSession, seed: int = 0, weeks: int = WEEKS) -> DataFrame:
    draw = _Draw(seed)
    places = F.array(
        *[F.struct(F.lit(c).alias("city"), F.lit(s).alias("state")) for c, s in zip(CITIES, STATES)]
    )
    return sample_weeks(spark, weeks).select("week_start_date", F.inline(places)).select(
        "week_start_date", "city", "state",
        draw.whole(10, 100).alias("total_bookings"),
        draw.whole(100, 500).alias("total_viewings"),
        draw.real(100, 300).alias("avg_price"),
        draw.real(5, 20).alias("booking_conversion_rate"),
    )


def top_listings(spark: SparkSession, seed: int = 0, weeks: int = WEEKS) -> DataFrame:
    draw = _Draw(seed)
    members = F.sequence(F.lit(1).cast("bigint"), F.lit(LISTINGS_PER_WEEK).cast("bigint"))
    return sample_weeks(spark, weeks).select(
        "week_start_date", F.explode(members).alias("apartment_id")
    ).select(
        "week_start_date", "apartment_id",
        F.concat(F.lit("Luxury Apartment "), F.col("apartment_id").cast("string")).alias("title"),
        draw.choice(CITIES).alias("city"),
        draw.choice(STATES).alias("state"),
        draw.real(1000, 5000).alias("total_revenue"),
        draw.whole(1, 10).alias("total_bookings"),
        draw.real(2, 10).alias("avg_stay_duration"),
        draw.real(40, 95).alias("occupancy_rate"),
    )


def user_engagement(spark: SparkSession, seed: int = 0, weeks: int = WEEKS) -> DataFrame:
    draw = _Draw(seed)
    return sample_weeks(spark, weeks).select(
        "week_start_date",
        draw.whole(500, 1500).alias("total_users"),
        draw.whole(300, 1000).alias("active_users"),
        draw.whole(50, 200).alias("new_users"),
        draw.whole(200, 800).alias("total_bookings"),
        draw.real(1, 3).alias("avg_bookings_per_user"),
        draw.real(2, 7).alias("avg_booking_duration"),
        draw.real(10, 40).alias("repeat_customer_rate"),
    )


def user_booking_history(spark: SparkSession, seed: int = 0, weeks: int = WEEKS) -> DataFrame:
    draw = _Draw(seed)
    members = F.sequence(F.lit(1).cast("bigint"), F.lit(USERS).cast("bigint"))
    return sample_weeks(spark, weeks).select(
        "week_start_date", F.explode(members).alias("user_id")
    ).select(
        "user_id", "week_start_date",
        draw.whole(0, 5).alias("total_bookings"),
        draw.real(0, 2000).alias("total_spend"),
        draw.real(1, 10).alias("avg_booking_duration"),
        draw.choice(CITIES).alias("favorite_city"),
        (draw.share() < REPEAT_SHARE).alias("is_repeat_customer"),
    )
