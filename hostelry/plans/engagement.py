"""User engagement datasets.

Activity is first reduced to one row per (user, day).  Everything after that,
including the per-user windows, sees at most one row per user and day.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import guarded_ratio, money, period_start
from ..operators.facts import user_days_of
from ..operators.repeat import flag_repeat_days
from .kpis import CONFIRMED
from .rental import BOOKING, bookings_of, known_stay


def _user_days(activity: DataFrame) -> DataFrame:
    at = F.col("activity_date")
    booking = F.col("activity_type") == BOOKING
    confirmed_stay = F.when(booking & (F.col("booking_status") == CONFIRMED), known_stay())
    return (
        activity.where(at.isNotNull() & F.col("user_id").isNotNull())
        .groupBy("user_id", F.to_date(at).alias("day"))
        .agg(
            F.count_if(booking).alias("bookings"),
            F.min(F.when(booking, at)).alias("first_booking"),
            F.max(F.when(booking, at)).alias("last_booking"),
            F.sum(F.when(booking, money(F.col("total_price")))).alias("spend"),
            F.sum(F.when(booking, known_stay())).alias("nights"),
            F.count(F.when(booking, known_stay())).alias("stays"),
            F.sum(confirmed_stay).alias("confirmed_nights"),
            F.count(confirmed_stay).alias("confirmed_stays"),
        )
    )


def user_engagement(
    activity: DataFrame, repeat_days: int = 30, week_start: str = "MON"
) -> DataFrame:
    """Weekly users, new users, bookings per user, stay length and repeat rate."""
    return engagement_of(_user_days(activity), repeat_days, week_start)


def engagement_of(user_days: DataFrame, repeat_days: int = 30, week_start: str = "MON") -> DataFrame:
    """The dataset from one row per (user, day)."""
    week = period_start(F.col("day"), "week", week_start)
    first_day = F.row_number().over(W.partitionBy("user_id").orderBy("day")) == 1
    # The windows leave the rows partitioned by user, so this grouping stays local.
    user_weeks = (
        flag_repeat_days(user_days, repeat_days)
        .withColumn("is_new", first_day)
        .groupBy("user_id", week.alias("week_start_date"))
        .agg(
            F.sum("bookings").alias("bookings"),
            F.bool_or("is_repeat").alias("is_repeat"),
            F.bool_or("is_new").alias("is_new"),
            F.sum("confirmed_nights").alias("nights"),
            F.sum("confirmed_stays").alias("stays"),
        )
    )
    weeks = user_weeks.groupBy("week_start_date").agg(
        F.count(F.lit(1)).alias("active_users"),
        F.count_if("is_new").alias("new_users"),
        F.sum("bookings").alias("total_bookings"),
        F.count_if(F.col("bookings") > 0).alias("bookers"),
        F.count_if("is_repeat").alias("repeaters"),
        F.sum("nights").alias("nights"),
        F.sum("stays").alias("stays"),
    )
    so_far = W.orderBy("week_start_date").rowsBetween(W.unboundedPreceding, W.currentRow)
    return weeks.select(  # one row per week
        "week_start_date",
        F.sum("new_users").over(so_far).alias("total_users"),
        "active_users", "new_users", "total_bookings",
        guarded_ratio(F.col("total_bookings"), F.col("bookers")).alias("avg_bookings_per_user"),
        F.try_divide(F.col("nights").cast("double"), F.col("stays")).alias("avg_booking_duration"),
        guarded_ratio(F.col("repeaters"), F.col("bookers"), 100.0).alias("repeat_customer_rate"),
    )


def engagement_after(
    stored: DataFrame, some_user_days: DataFrame, first_days: DataFrame, weeks: Sequence[date],
    repeat_days: int = 30, week_start: str = "MON",
) -> DataFrame:
    """The dataset ``stored`` after a change of activity that touches ``weeks`` only.

    ``some_user_days``, one row per (user, day), holds those weeks and the repeat window before
    them; the other weeks keep their figures.  A new first day of a user also changes the week
    that was the first, so the users are counted anew from ``first_days`` (user_id, day).
    """
    touched, counted = F.col("week_start_date").isin(list(weeks)), ("total_users", "new_users")
    fresh = engagement_of(some_user_days, repeat_days, week_start)
    figures = fresh.where(touched).drop(*counted).unionByName(stored.where(~touched).select(*[c for c in fresh.columns if c not in counted]))
    week = period_start(F.col("day"), "week", week_start)
    begun = first_days.groupBy(week.alias("week_start_date")).agg(F.count(F.lit(1)).alias("new_users"))
    so_far = W.orderBy("week_start_date").rowsBetween(W.unboundedPreceding, W.currentRow)
    known = figures.join(F.broadcast(begun), "week_start_date", "left").withColumn("new_users", F.coalesce("new_users", F.lit(0)))
    return known.withColumn("total_users", F.sum("new_users").over(so_far)).select(*fresh.columns)  # one row per week


def weekly_active_users(
    activity: DataFrame, week_start: str = "MON", approx: bool = False
) -> DataFrame:
    """Different users with any activity per week, exact or as a sketch."""
    week = period_start(F.col("activity_date"), "week", week_start)
    users = F.approx_count_distinct("user_id") if approx else F.countDistinct("user_id")
    known = activity.where(F.col("activity_date").isNotNull())
    return known.groupBy(week.alias("week_start_date")).agg(users.alias("active_users"))


def favorite_cities(bookings: DataFrame, details: DataFrame, week_start: str = "MON") -> DataFrame:
    """Most booked city per (user, week), ties by name.

    Bookings are counted per (user, week, listing) before the lookup.  A listing
    with a large share of the rows is split by the adaptive skew join; its
    details are a single row.
    """
    week = period_start(F.col("activity_date"), "week", week_start)
    counted = bookings.groupBy("user_id", week.alias("week_start_date"), "apartment_id").agg(F.count(F.lit(1)).alias("n"))
    return favorites_of(counted, details)


def favorites_of(counted: DataFrame, details: DataFrame) -> DataFrame:
    """The most booked city from the bookings ``n`` per (user, week, listing)."""
    per_city = (
        counted.join(details.select("apartment_id", "city"), "apartment_id")
        .where(F.col("city").isNotNull())
        .groupBy("user_id", "week_start_date", "city")
        .agg(F.sum("n").alias("n"))
    )
    most = F.min_by("city", F.struct(-F.col("n"), F.col("city")))
    return per_city.groupBy("user_id", "week_start_date").agg(most.alias("favorite_city"))


def user_booking_history(
    activity: DataFrame, details: DataFrame, repeat_days: int = 30, week_start: str = "MON",
    since: Column | None = None,
) -> DataFrame:
    """Bookings, spend, stay, favourite city and repeat flag per (user, week).

    ``since`` limits the result to weeks from that week start on; only the
    bookings of those weeks and of the repeat window before them are read.
    """
    at = F.col("activity_date")
    bookings = bookings_of(activity).where(at.isNotNull() & F.col("user_id").isNotNull())
    wanted = bookings
    if since is not None:
        start = since.cast("timestamp")
        wanted = bookings.where(at >= start)
        bookings = bookings.where(at >= start - F.expr(f"interval {int(repeat_days)} days"))
    history = _history(_user_days(bookings), repeat_days, week_start)
    if since is not None:
        history = history.where(F.col("week_start_date") >= since)
    return _with_favorites(history, favorite_cities(wanted, details, week_start))


def history_of(
    user_days: DataFrame, details: DataFrame, repeat_days: int = 30, week_start: str = "MON", weeks: Sequence[date] | None = None,
) -> DataFrame:
    """The dataset from bookings per (user, day, listing).

    ``weeks`` limits it to those weeks; days before them only count for the repeat window.
    """
    week = period_start(F.col("day"), "week", week_start)
    booked = user_days.where(F.col("bookings") > 0)
    history = _history(user_days_of(booked), repeat_days, week_start)
    # Hardly a user books a listing twice in a week, so the rows are looked up as they are and grouped by city alone.
    counted = booked.select("user_id", week.alias("week_start_date"), "apartment_id", F.col("bookings").alias("n"))
    if weeks is not None:
        history, counted = (df.where(F.col("week_start_date").isin(list(weeks))) for df in (history, counted))
    return _with_favorites(history, favorites_of(counted, details))


def _history(user_days: DataFrame, repeat_days: int, week_start: str) -> DataFrame:
    week = period_start(F.col("day"), "week", week_start)
    return (
        flag_repeat_days(user_days, repeat_days)
        .groupBy("user_id", week.alias("week_start_date"))
        .agg(
            F.sum("bookings").alias("total_bookings"),
            F.sum("spend").cast("double").alias("total_spend"),
            F.try_divide(F.sum("nights").cast("double"), F.sum("stays")).alias("avg_booking_duration"),
            F.bool_or("is_repeat").alias("is_repeat_customer"),
        )
    )


def _with_favorites(history: DataFrame, favorites: DataFrame) -> DataFrame:
    return history.join(favorites, ["user_id", "week_start_date"], "left").select(
        "user_id", "week_start_date", "total_bookings", "total_spend", "avg_booking_duration",
        "favorite_city", "is_repeat_customer",
    )
