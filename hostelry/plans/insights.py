"""Answers over the presentation datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.aggregates import pearson, trend_columns
from ..functions.columns import city_label, day_text, guarded_ratio, percent_change
from ..operators.distribution import gaussian_kde, histogram, value_counts
from ..operators.periods import latest
from ..operators.ranking import keep_keys, latest_top_k, pivot_unique, top_totals

WEEK = "week_start_date"


def series_summary(weekly: DataFrame, value: str) -> DataFrame:
    """Mean, max, min and first-to-last trend of one weekly measure."""
    columns = trend_columns(F.col(value), F.col(WEEK))
    return weekly.agg(*[column.alias(name) for name, column in columns.items()])


def price_summary(performance: DataFrame) -> DataFrame:
    return series_summary(performance, "avg_listing_price")


def occupancy_summary(performance: DataFrame) -> DataFrame:
    return series_summary(performance, "occupancy_rate")


def bookings_per_user_summary(engagement: DataFrame) -> DataFrame:
    return series_summary(engagement, "avg_bookings_per_user")


def duration_summary(engagement: DataFrame) -> DataFrame:
    return series_summary(engagement, "avg_booking_duration")


def repeat_rate_summary(engagement: DataFrame) -> DataFrame:
    return series_summary(engagement, "repeat_customer_rate")


def top_cities_latest(locations: DataFrame, k: int = 10) -> DataFrame:
    """Most booked places of the latest week, labelled."""
    order = [F.col("total_bookings").desc_nulls_last(), F.col("city").asc_nulls_last(), F.col("state")]
    return latest_top_k(locations, WEEK, order, k).select(
        city_label(F.col("city"), F.col("state")).alias("place"),
        day_text(F.col(WEEK)).alias("week"),
        "total_bookings", "total_viewings", "avg_price", "booking_conversion_rate",
    )


def city_trends(locations: DataFrame, k: int = 5) -> DataFrame:
    """Weekly bookings of the ``k`` most booked cities, one column per city.

    Reads at most ``k`` names to the driver, since they become column names.
    ``locations`` is read twice: pass a stored table, or take ``ranked_city_trends``.
    A name in several states is one city.
    """
    weekly = _city_weeks(locations)
    top = top_totals(weekly, "city", "total_bookings", k)
    names = [r["city"] for r in top.collect()]
    rows = keep_keys(weekly, top, "city")
    return pivot_unique(rows, WEEK, "city", "total_bookings", names)


def _city_weeks(locations: DataFrame) -> DataFrame:
    known = locations.where(F.col("city").isNotNull())
    return known.groupBy(WEEK, "city").agg(F.sum("total_bookings").alias("total_bookings"))


def ranked_city_trends(locations: DataFrame, k: int = 5) -> DataFrame:
    """The same with fixed columns: city_1, bookings_1 ... for the city of each rank.

    The pivot is on the rank, known in advance, so nothing is read to the driver.  A week
    without the city of some rank has null there.
    """
    weekly = _city_weeks(locations)
    top = top_totals(weekly, "city", "total_bookings", k)
    order = W.orderBy(F.col("total").desc_nulls_last(), F.col("city"))  # over k rows
    ranks = top.select("city", F.row_number().over(order).alias("rank"))
    cells = weekly.join(F.broadcast(ranks), "city")
    columns = []
    for i in range(1, k + 1):
        mine = F.col("rank") == i
        columns.append(F.max(F.when(mine, F.col("city"))).alias(f"city_{i}"))
        columns.append(F.max(F.when(mine, F.col("total_bookings"))).alias(f"bookings_{i}"))
    return cells.groupBy(WEEK).agg(*columns)


def top_listings_latest(listing_weeks: DataFrame, k: int = 10) -> DataFrame:
    order = [F.col("total_revenue").desc_nulls_last(), F.col("apartment_id")]
    return latest_top_k(listing_weeks, WEEK, order, k)


def occupancy_revenue_correlation(listing_weeks: DataFrame, k: int = 10) -> DataFrame:
    """Over the top listings of the latest week."""
    return top_listings_latest(listing_weeks, k).agg(
        pearson(F.col("occupancy_rate"), F.col("total_revenue")).alias("correlation")
    )


def latest_week(df: DataFrame, week: Column | str = WEEK) -> DataFrame:
    """Rows of the latest week; on a stored table only that week is read."""
    column = F.col(week) if isinstance(week, str) else week
    return df.where(column == latest(df, column))


def booking_count_distribution(history: DataFrame) -> DataFrame:
    """Users of one week by number of bookings, with their share in percent."""
    return value_counts(history, "total_bookings")


def booking_histogram(history: DataFrame, bins: int = 10) -> DataFrame:
    return histogram(history, "total_bookings", bins)


def booking_kde(history: DataFrame, points: int = 200) -> DataFrame:
    return gaussian_kde(history, "total_bookings", points)


def duration_spend_correlation(history: DataFrame) -> DataFrame:
    """Over the users of one week who booked."""
    booked = history.where(F.col("total_bookings") > 0)
    return booked.agg(
        pearson(F.col("avg_booking_duration"), F.col("total_spend")).alias("correlation")
    )


def repeat_comparison(history: DataFrame) -> DataFrame:
    """Repeat against one-time customers of one week, as one row."""
    repeat = F.col("is_repeat_customer")
    kinds = {"repeat": repeat, "one_time": ~repeat}
    aggregates = [F.count(F.lit(1)).alias("customers")]
    for name, mine in kinds.items():
        aggregates += [
            F.count_if(mine).alias(f"{name}_customers"),
            F.avg(F.when(mine, F.col("total_spend"))).alias(f"{name}_avg_spend"),
            F.avg(F.when(mine, F.col("avg_booking_duration"))).alias(f"{name}_avg_duration"),
        ]
    out = history.agg(*aggregates)
    added = {
        f"{name}_share_pct": guarded_ratio(F.col(f"{name}_customers"), F.col("customers"), 100.0)
        for name in kinds
    }
    for measure in ("spend", "duration"):
        base = F.col(f"one_time_avg_{measure}")
        gap = F.col(f"repeat_avg_{measure}") - base
        added[f"{measure}_difference"] = gap
        added[f"{measure}_uplift_pct"] = percent_change(gap, base)
    return out.withColumns(added)


def customers_by_kind(history: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repeat, one-time) customers; an unknown flag is in neither."""
    flag = F.col("is_repeat_customer")
    return history.where(flag), history.where(~flag)


def activity_rate(engagement: DataFrame) -> DataFrame:
    """Active share of all users per week, in percent."""
    rate = guarded_ratio(F.col("active_users"), F.col("total_users"), 100.0)
    return engagement.select(WEEK, "active_users", "total_users", rate.alias("activity_rate"))


def average_activity_rate(engagement: DataFrame) -> DataFrame:
    return activity_rate(engagement).agg(F.avg("activity_rate").alias("avg_activity_rate"))
