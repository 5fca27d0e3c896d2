"""Raw to curated: renames, derived fields, the activity union, dense ids."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import as_of_literal
from ..schemas import TABLES
from ..session import materialize
from .conform import conform, truncate_columns
from .enrich import listing_price_column, price_per_sqft

ACTIVITY_ORDER = ("activity_date", "activity_type", "source_id")


def _finish(df: DataFrame, table: str, as_of: datetime) -> DataFrame:
    stamped = df.withColumn("etl_inserted_at", as_of_literal(as_of))
    return truncate_columns(conform(stamped, TABLES[table]), TABLES[table].text_limits)


def curated_apartments(enriched: DataFrame, as_of: datetime) -> DataFrame:
    renamed = enriched.withColumnsRenamed(
        {"id": "apartment_id", "days_since_listing": "days_listed"}
    )
    return _finish(renamed, "curated_apartments", as_of)


def curated_details(enriched: DataFrame, apartments: DataFrame, as_of: datetime) -> DataFrame:
    """Details per listing.  Without a price of its own an attribute row takes
    the price of its listing, so that the price per square foot is defined."""
    details = enriched
    if listing_price_column(enriched) is None:
        prices = apartments.select(
            F.col("id").alias("apartment_id"), F.col("price").alias("listing_price")
        )
        details = details.join(prices, "apartment_id", "left").withColumn(
            "price_per_sqft", price_per_sqft(F.col("listing_price"), F.col("square_feet"))
        )
    renamed = details.withColumnsRenamed({"cityname": "city", "amenities": "amenities_text"})
    return _finish(renamed, "curated_apartment_details", as_of)


def user_activity(viewings: DataFrame, bookings: DataFrame, as_of: datetime) -> DataFrame:
    """Viewings and bookings in one shape, told apart by ``activity_type``.

    ``source_id`` is the id in the source table; ``with_activity_ids`` turns it
    into the surrogate key.
    """
    viewed = viewings.withColumnsRenamed({"id": "source_id", "viewed_at": "activity_date"})
    booked = bookings.withColumnsRenamed(
        {
            "id": "source_id",
            "booking_date": "activity_date",
            "booking_duration_days": "stay_duration",
        }
    )
    table = TABLES["curated_user_activity"]

    def shaped(df: DataFrame, kind: str) -> DataFrame:
        kept = ["source_id", *(c for c in table.schema.names if c in df.columns)]
        return df.select(*kept).withColumn("activity_type", F.lit(kind))

    both = shaped(viewed, "viewing").unionByName(
        shaped(booked, "booking"), allowMissingColumns=True
    )
    stamped = both.withColumn("etl_inserted_at", as_of_literal(as_of))
    shaped_rows = conform(stamped, table, keep_extra=True).drop("activity_id")
    return truncate_columns(shaped_rows, table.text_limits)


def with_activity_ids(activity: DataFrame) -> DataFrame:
    """Dense ids 1..n by (activity_date, activity_type, source_id).

    The rows are range-partitioned, sorted and written once; an id is then the
    rows in earlier files plus the position inside the file.  The only window
    runs over one row per written file; those rows are broadcast, so the
    activity itself is not shuffled again and stays in time order.
    """
    stored = materialize(
        activity.repartitionByRange(*ACTIVITY_ORDER).sortWithinPartitions(*ACTIVITY_ORDER),
        "activity",
    )
    placed = stored.select(
        *stored.columns,
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("position"),
    )
    number = lambda pattern: F.regexp_extract("file", pattern, 1).cast("int")
    earlier = W.orderBy("part", "piece").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
        .withColumns({"part": number(r"part-(\d+)-"), "piece": number(r"-c(\d+)\.")})
        .select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("skipped"))
    )
    columns = TABLES["curated_user_activity"].schema.names
    return (
        placed.join(F.broadcast(offsets), "file")
        .withColumn("activity_id", F.col("skipped") + F.col("position") + 1)
        .select(*columns)
    )
