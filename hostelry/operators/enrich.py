"""The four row-level enrichments of the raw tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_of_literal

SECONDS_PER_DAY = 86400


def _has(df: DataFrame, *names: str) -> bool:
    return set(names) <= set(df.columns)


def _span(start: str, end: str, length: Column) -> Column:
    """``length`` when both ends are known, else 0."""
    known = F.col(start).isNotNull() & F.col(end).isNotNull()
    return F.when(known, length).otherwise(F.lit(0))


def enrich_apartments(df: DataFrame, as_of: datetime) -> DataFrame:
    now, listed = as_of_literal(as_of), F.col("listing_created_on")
    return df.withColumns(
        {
            "processed_at": now,
            "days_since_listing": F.when(listed.isNotNull(), F.datediff(now, listed)).otherwise(0),
            "price_usd": F.col("price"),
        }
    )


def enrich_viewings(df: DataFrame, as_of: datetime, exact: bool = False) -> DataFrame:
    """Viewing duration in seconds, at day resolution unless ``exact``."""
    duration = F.lit(0)
    if _has(df, "viewed_at", "viewing_end_time"):
        start, end = F.col("viewed_at"), F.col("viewing_end_time")
        if exact:
            length = F.unix_timestamp(end) - F.unix_timestamp(start)
        else:
            length = F.datediff(end, start) * SECONDS_PER_DAY
        duration = _span("viewed_at", "viewing_end_time", length)
    return df.withColumns(
        {"processed_at": as_of_literal(as_of), "viewing_duration_seconds": duration}
    )


def enrich_bookings(df: DataFrame, as_of: datetime) -> DataFrame:
    added = {"processed_at": as_of_literal(as_of)}
    if _has(df, "checkin_date", "checkout_date"):
        nights = F.datediff(F.col("checkout_date"), F.col("checkin_date"))
        added["booking_duration_days"] = _span("checkin_date", "checkout_date", nights)
    return df.withColumns(added)


def price_per_sqft(price: Column, square_feet: Column) -> Column:
    usable = (square_feet > 0) & price.isNotNull()
    return F.when(usable, price.cast("double") / square_feet).otherwise(F.lit(0.0))


def listing_price_column(df: DataFrame) -> str | None:
    """The attribute column that carries a price, ``price_display`` first."""
    return next((c for c in ("price_display", "price") if c in df.columns), None)


def enrich_attributes(df: DataFrame, as_of: datetime) -> DataFrame:
    price = listing_price_column(df)
    rate = F.lit(0.0)
    if price and _has(df, "square_feet"):
        rate = price_per_sqft(F.col(price), F.col("square_feet"))
    return df.withColumns({"processed_at": as_of_literal(as_of), "price_per_sqft": rate})


def with_constant_currency(bookings: DataFrame, currency: str = "USD") -> DataFrame:
    """Seed rule: every booking is in one currency."""
    return bookings.withColumn("currency", F.lit(currency))
