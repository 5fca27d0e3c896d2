"""Rental performance datasets.

All take the curated tables.  Rates are percent.  Facts are reduced per listing
before any join, so a popular listing crosses a shuffle as a few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import guarded_ratio, money, period_end, period_start
from ..operators.medians import running_median
from ..operators.periods import nights_per_period, period_spine, stay_masks
from ..operators.ranking import top_per_group
from ..session import materialize
from .kpis import CONFIRMED

BOOKING, VIEWING = "booking", "viewing"


def bookings_of(activity: DataFrame) -> DataFrame:
    return activity.where(F.col("activity_type") == BOOKING)


def confirmed_of(activity: DataFrame) -> DataFrame:
    return bookings_of(activity).where(F.col("booking_status") == CONFIRMED)


def known_stay() -> Column:
    """Nights of a booking whose two dates are known; null otherwise."""
    known = F.col("checkin_date").isNotNull() & F.col("checkout_date").isNotNull()
    return F.when(known, F.col("stay_duration"))


def _from(df: DataFrame, at: str, since: Column | None) -> DataFrame:
    """Rows from the day ``since`` on; the bound reaches the scan."""
    return df if since is None else df.where(F.col(at) >= since.cast("timestamp"))


def listings(apartments: DataFrame, details: DataFrame) -> DataFrame:
    """One row per listing; the two sides share the key, so neither is skewed."""
    return apartments.select(
        "apartment_id", "title", "price", "is_active", "listing_created_on"
    ).join(
        details.select("apartment_id", "city", "state", "price_per_sqft"), "apartment_id", "left"
    )


def rental_performance(
    apartments: DataFrame, details: DataFrame, activity: DataFrame, grain: str = "week",
    week_start: str = "MON", approx_median: bool = False,
) -> DataFrame:
    """Price, supply and occupancy per week or month.

    A listing is active in a period when it is flagged active now and was
    created before the period's end.  Counts and sums are running totals over
    creation periods, so listings are never repeated per period.
    """
    nights = nights_per_period(confirmed_of(activity), grain, week_start)
    last = activity.agg(period_start(F.max("activity_date"), grain, week_start).alias("last"))
    return performance_of(apartments, details, nights, last, grain, week_start, approx_median)


def supply(apartments: DataFrame, details: DataFrame) -> DataFrame:
    """Listings per (day of creation, price, active flag) with their rates, stored once for every use.

    Counts, prices and medians of all grains come from it, so the listing tables are read once for
    all of them.  Listings without a creation date are left out.
    """
    rate = F.col("price_per_sqft")
    known = apartments.select(
        "apartment_id", "price", F.coalesce("is_active", F.lit(False)).alias("active"),
        F.to_date("listing_created_on").alias("created"),
    ).where(F.col("created").isNotNull())
    reduced = (
        known.join(details.select("apartment_id", rate), "apartment_id", "left")
        .groupBy("created", "price", "active")
        .agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.when(rate > 0, rate)).alias("rate_sum"),
            F.count_if(rate > 0).alias("rated"),
        )
    )
    return materialize(reduced, "supply")


def performance_of(
    apartments: DataFrame, details: DataFrame, nights: DataFrame, last: DataFrame, grain: str = "week",
    week_start: str = "MON", approx_median: bool = False, stored: DataFrame | None = None,
) -> DataFrame:
    """The dataset from booked nights per (listing, period) and the last period, a row of one column.

    ``stored`` is the ``supply`` of the listings where it is at hand; otherwise it is stored here.
    """
    label = f"{grain}_start_date"
    if stored is None:
        stored = supply(apartments, details)
    offered = stored.withColumn("created", period_start(F.col("created"), grain, week_start))
    price, active = money(F.col("price")), F.col("active")
    per_created = offered.groupBy(F.col("created").alias("period")).agg(
        F.sum("n").alias("new_listings"),
        F.coalesce(F.sum(F.when(active, F.col("n"))), F.lit(0)).alias("listings"),
        F.sum(F.when(active, price * F.col("n"))).alias("price_sum"),
        F.coalesce(F.sum(F.when(active & price.isNotNull(), F.col("n"))), F.lit(0)).alias("priced"),
        F.sum(F.when(active, F.col("rate_sum"))).alias("rate_sum"),
        F.coalesce(F.sum(F.when(active, F.col("rated"))), F.lit(0)).alias("rated"),
    )
    medians = running_median(
        offered.where("active").select(F.col("created").alias("period"), F.col("price").alias("value"), "n"),
        approx=approx_median, weight="n",
    )
    begun = period_start(F.col("listing_created_on"), grain, week_start)
    occupied = (
        nights.join(apartments.where("is_active").select("apartment_id", begun.alias("created")), "apartment_id")
        .where(F.col("created") <= F.col("period"))
        .groupBy("period")
        .agg(F.sum("nights").alias("nights"))
    )
    bounds = (
        offered.agg(F.min("created").alias("first"), F.max("created").alias("newest"))
        .unionByName(last, allowMissingColumns=True)
        .agg(F.min("first").alias("first"),
             F.coalesce(F.max("last"), F.max("newest")).alias("last"))
    )

    # One row per period from here on: the windows and broadcasts are bounded by
    # the calendar.
    so_far = W.orderBy("period").rowsBetween(W.unboundedPreceding, W.currentRow)
    totals = ("listings", "price_sum", "priced", "rate_sum", "rated")
    period = F.col("period")
    available = F.datediff(period_end(period, grain), period) * F.col("listings")
    return (
        period_spine(bounds, grain)
        .join(F.broadcast(per_created), "period", "left")
        .join(F.broadcast(medians), "period", "left")
        .join(F.broadcast(occupied), "period", "left")
        .select(
            "period", "nights", F.coalesce("new_listings", F.lit(0)).alias("new_listings"),
            F.last("median", ignorenulls=True).over(so_far).alias("median"),
            *[F.sum(F.coalesce(c, F.lit(0))).over(so_far).alias(c) for c in totals],
        )
        .select(
            period.alias(label),
            F.try_divide(F.col("price_sum").cast("double"), F.col("priced")).alias("avg_listing_price"),
            F.col("median").alias("median_listing_price"),
            F.col("listings").alias("total_active_listings"),
            "new_listings",
            guarded_ratio(F.coalesce("nights", F.lit(0)), available, 100.0).alias("occupancy_rate"),
            F.try_divide(F.col("rate_sum"), F.col("rated")).alias("avg_price_per_sqft"),
        )
    )


def popular_locations(
    apartments: DataFrame, details: DataFrame, activity: DataFrame, week_start: str = "MON",
    since: Column | None = None,
) -> DataFrame:
    """Weekly bookings, viewings and conversion per place.

    Both kinds of activity are counted in one pass over the activity table, so
    no outer join of two aggregates is needed.
    """
    week = period_start(F.col("activity_date"), "week", week_start)
    per_listing = (
        _from(activity, "activity_date", since)
        .where(F.col("activity_date").isNotNull())
        .groupBy(week.alias("week_start_date"), "apartment_id")
        .agg(
            F.count_if(F.col("activity_type") == BOOKING).alias("bookings"),
            F.count_if(F.col("activity_type") == VIEWING).alias("viewings"),
        )
    )
    return locations_of(apartments, details, per_listing)


def locations_of(apartments: DataFrame, details: DataFrame, per_listing: DataFrame) -> DataFrame:
    """The dataset from bookings and viewings per (week, listing)."""
    places = listings(apartments, details).select("apartment_id", "city", "state", "price")
    price, booked = money(F.col("price")), F.col("bookings")
    return (
        per_listing.join(places, "apartment_id", "left")
        .groupBy("week_start_date", "city", "state")
        .agg(
            F.sum("bookings").alias("total_bookings"),
            F.sum("viewings").alias("total_viewings"),
            F.try_divide(
                F.sum(price * booked).cast("double"), F.sum(F.when(price.isNotNull(), booked))
            ).alias("avg_price"),
        )
        .withColumn(
            "booking_conversion_rate",
            guarded_ratio(F.col("total_bookings"), F.col("total_viewings"), 100.0),
        )
    )


def listing_weeks(activity: DataFrame, week_start: str = "MON", since: Column | None = None) -> DataFrame:
    """Revenue, bookings, stay and nights per (week, listing) with a booking.

    Booked money and booked nights are stacked and reduced together: one shuffle
    on (week, listing) and no join between the two.
    """
    confirmed = confirmed_of(activity)
    made = _from(confirmed, "activity_date", since).select(
        "apartment_id",
        period_start(F.col("activity_date"), "week", week_start).alias("period"),
        money(F.col("total_price")).alias("revenue"),
        known_stay().alias("stay"),
        F.lit(1).alias("made"),
    )
    masks = stay_masks(_from(confirmed, "checkout_date", since), "week", week_start)
    return (
        made.unionByName(masks, allowMissingColumns=True)
        .groupBy(F.col("period").alias("week_start_date"), "apartment_id")
        .agg(
            F.sum("revenue").cast("double").alias("total_revenue"),
            F.count("made").alias("total_bookings"),
            F.avg("stay").alias("avg_stay_duration"),
            (F.bit_count(F.coalesce(F.bit_or("mask"), F.lit(0).cast("long"))) * 100.0 / F.lit(7.0))
            .cast("double").alias("occupancy_rate"),
        )
        .where((F.col("total_bookings") > 0) & F.col("week_start_date").isNotNull())
    )


def top_listings(
    apartments: DataFrame, details: DataFrame, activity: DataFrame, n: int = 10,
    week_start: str = "MON", since: Column | None = None,
) -> DataFrame:
    """The ``n`` listings with the highest confirmed revenue of each week."""
    return top_of(apartments, details, listing_weeks(activity, week_start, since), n)


def top_of(apartments: DataFrame, details: DataFrame, weeks: DataFrame, n: int = 10) -> DataFrame:
    """The dataset from the figures per (week, listing)."""
    ranked = top_per_group(
        weeks, "week_start_date",
        [F.col("total_revenue").desc_nulls_last(), F.col("apartment_id").asc()], n,
    )
    named = listings(apartments, details).select("apartment_id", "title", "city", "state")
    return ranked.join(named, "apartment_id", "left").select(
        "week_start_date", "apartment_id", "title", "city", "state", "total_revenue",
        "total_bookings", "avg_stay_duration", "occupancy_rate",
    )
