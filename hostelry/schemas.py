"""The fourteen tables of the three layers, with their declared constraints."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T

RAW, CURATED, PRESENTATION = "raw_data", "curated", "presentation"
LAYERS = (RAW, CURATED, PRESENTATION)

LONG, INT, DOUBLE = T.LongType(), T.IntegerType(), T.DoubleType()
TEXT, FLAG, TIME, DAY = T.StringType(), T.BooleanType(), T.TimestampType(), T.DateType()


@dataclass(frozen=True)
class Table:
    """Schema and declared constraints of one table.

    ``spread`` and ``order`` are the declared distribution and sort keys;
    ``spread="ALL"`` marks tables small enough to copy to every executor
    because their row count is bounded by the calendar.
    """

    layer: str
    name: str
    schema: T.StructType
    key: tuple[str, ...]
    unique: tuple[str, ...] = ()
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)
    spread: str | None = None
    order: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if f.metadata.get("required")]

    @property
    def text_limits(self) -> dict[str, int]:
        return {
            f.name: f.metadata["varchar_len"] for f in self.schema if "varchar_len" in f.metadata
        }


def _col(name, data_type, length=None, required=False) -> T.StructField:
    # Nullability is checked by the quality operators, not promised by files.
    meta = {}
    if length is not None:
        meta["varchar_len"] = length
    if required:
        meta["required"] = True
    return T.StructField(name, data_type, True, meta)


def _schema(*columns) -> T.StructType:
    return T.StructType([_col(*c) for c in columns] + [_col("etl_inserted_at", TIME)])


_WEEK_MEASURES = (
    ("avg_listing_price", DOUBLE),
    ("median_listing_price", DOUBLE),
    ("total_active_listings", LONG),
    ("new_listings", LONG),
    ("occupancy_rate", DOUBLE),
    ("avg_price_per_sqft", DOUBLE),
)

_ALL = [
    Table(
        RAW, "apartments",
        _schema(
            ("id", LONG, None, True), ("title", TEXT, 255, True), ("source", TEXT, 50),
            ("price", DOUBLE, None, True), ("currency", TEXT, 3), ("listing_created_on", TIME),
            ("is_active", FLAG), ("last_modified_timestamp", TIME),
        ),
        key=("id",), spread="id", order=("id", "last_modified_timestamp"),
    ),
    Table(
        RAW, "apartment_attributes",
        _schema(
            ("id", LONG, None, True), ("apartment_id", LONG), ("category", TEXT, 50), ("body", TEXT),
            ("amenities", TEXT), ("bathrooms", INT), ("bedrooms", INT), ("fee", DOUBLE),
            ("has_photo", FLAG), ("pets_allowed", FLAG), ("square_feet", INT),
            ("address", TEXT, 255), ("cityname", TEXT, 100), ("state", TEXT, 50),
            ("latitude", DOUBLE), ("longitude", DOUBLE),
        ),
        key=("id",), parents={"apartment_id": ("apartments", "id")},
        spread="apartment_id", order=("apartment_id",),
    ),
    Table(
        RAW, "user_viewings",
        _schema(
            ("id", LONG, None, True), ("user_id", LONG, None, True), ("apartment_id", LONG),
            ("viewed_at", TIME), ("is_wishlisted", FLAG), ("call_to_action", TEXT, 50),
        ),
        key=("id",), parents={"apartment_id": ("apartments", "id")},
        spread="apartment_id", order=("viewed_at", "apartment_id"),
    ),
    Table(
        RAW, "bookings",
        _schema(
            ("id", LONG, None, True), ("booking_id", LONG), ("user_id", LONG, None, True),
            ("apartment_id", LONG), ("booking_date", TIME, None, True), ("checkin_date", TIME),
            ("checkout_date", TIME), ("total_price", DOUBLE), ("currency", TEXT, 3),
            ("booking_status", TEXT, 20), ("payment_status", TEXT, 20), ("num_guests", INT),
        ),
        key=("id",), unique=("booking_id",), parents={"apartment_id": ("apartments", "id")},
        spread="apartment_id", order=("booking_date", "apartment_id"),
    ),
    Table(
        CURATED, "curated_apartments",
        _schema(
            ("apartment_id", LONG, None, True), ("title", TEXT, 255, True), ("source", TEXT, 50),
            ("price", DOUBLE, None, True), ("currency", TEXT, 3), ("listing_created_on", TIME),
            ("is_active", FLAG), ("last_modified_timestamp", TIME), ("days_listed", INT),
        ),
        key=("apartment_id",), spread="apartment_id",
        order=("apartment_id", "is_active", "last_modified_timestamp"),
    ),
    Table(
        CURATED, "curated_apartment_details",
        _schema(
            ("apartment_id", LONG, None, True), ("category", TEXT, 50), ("bathrooms", INT),
            ("bedrooms", INT), ("fee", DOUBLE), ("has_photo", FLAG), ("pets_allowed", FLAG),
            ("square_feet", INT), ("price_per_sqft", DOUBLE), ("address", TEXT, 255),
            ("city", TEXT, 100), ("state", TEXT, 50), ("latitude", DOUBLE), ("longitude", DOUBLE),
            ("amenities_text", TEXT, 4000),
        ),
        key=("apartment_id",), parents={"apartment_id": ("curated_apartments", "apartment_id")},
        spread="apartment_id", order=("apartment_id", "city", "state"),
    ),
    Table(
        CURATED, "curated_user_activity",
        _schema(
            ("activity_id", LONG, None, True), ("user_id", LONG, None, True), ("apartment_id", LONG),
            ("activity_type", TEXT, 20), ("activity_date", TIME), ("is_wishlisted", FLAG),
            ("call_to_action", TEXT, 50), ("booking_id", LONG), ("checkin_date", TIME),
            ("checkout_date", TIME), ("stay_duration", INT), ("total_price", DOUBLE),
            ("booking_status", TEXT, 20), ("payment_status", TEXT, 20), ("num_guests", INT),
        ),
        key=("activity_id",), parents={"apartment_id": ("curated_apartments", "apartment_id")},
        spread="apartment_id", order=("activity_date", "user_id", "apartment_id"),
        partition_by=("activity_type",),
    ),
    Table(
        PRESENTATION, "pres_rental_performance_weekly",
        _schema(("week_start_date", DAY, None, True), *_WEEK_MEASURES),
        key=("week_start_date",), spread="ALL", order=("week_start_date",),
    ),
    Table(
        PRESENTATION, "pres_rental_performance_monthly",
        _schema(("month_start_date", DAY, None, True), *_WEEK_MEASURES),
        key=("month_start_date",), spread="ALL", order=("month_start_date",),
    ),
    Table(
        PRESENTATION, "pres_popular_locations_weekly",
        _schema(
            ("week_start_date", DAY), ("city", TEXT, 100), ("state", TEXT, 50),
            ("total_bookings", LONG), ("total_viewings", LONG), ("avg_price", DOUBLE),
            ("booking_conversion_rate", DOUBLE),
        ),
        key=("week_start_date", "city", "state"), spread="city",
        order=("week_start_date", "city", "state"),
    ),
    Table(
        PRESENTATION, "pres_top_listings_weekly",
        _schema(
            ("week_start_date", DAY), ("apartment_id", LONG), ("title", TEXT, 255),
            ("city", TEXT, 100), ("state", TEXT, 50), ("total_revenue", DOUBLE),
            ("total_bookings", LONG), ("avg_stay_duration", DOUBLE), ("occupancy_rate", DOUBLE),
        ),
        key=("week_start_date", "apartment_id"), spread="apartment_id",
        order=("week_start_date", "total_revenue"),
    ),
    Table(
        PRESENTATION, "pres_user_engagement_weekly",
        _schema(
            ("week_start_date", DAY), ("total_users", LONG), ("active_users", LONG),
            ("new_users", LONG), ("total_bookings", LONG), ("avg_bookings_per_user", DOUBLE),
            ("avg_booking_duration", DOUBLE), ("repeat_customer_rate", DOUBLE),
        ),
        key=("week_start_date",), spread="ALL", order=("week_start_date",),
    ),
    Table(
        PRESENTATION, "pres_user_booking_history",
        _schema(
            ("user_id", LONG), ("week_start_date", DAY), ("total_bookings", LONG),
            ("total_spend", DOUBLE), ("avg_booking_duration", DOUBLE),
            ("favorite_city", TEXT, 100), ("is_repeat_customer", FLAG),
        ),
        key=("user_id", "week_start_date"), spread="user_id",
        order=("user_id", "week_start_date"), partition_by=("week_start_date",),
    ),
    Table(
        PRESENTATION, "presentation_metrics",
        _schema(
            ("metrics_date", DAY, None, True), ("total_listings", LONG), ("active_listings", LONG),
            ("avg_price", DOUBLE), ("min_price", DOUBLE), ("max_price", DOUBLE),
            ("avg_days_listed", DOUBLE), ("total_viewings", LONG), ("total_wishlisted", LONG),
            ("total_users", LONG), ("total_timed_viewings", LONG), ("avg_viewing_duration", DOUBLE),
            ("total_bookings", LONG), ("confirmed_bookings", LONG), ("avg_booking_value", DOUBLE),
            ("total_booking_value", DOUBLE), ("avg_booking_duration", DOUBLE),
            ("booking_conversion_rate", DOUBLE), ("wishlist_rate", DOUBLE),
            ("avg_viewings_per_listing", DOUBLE), ("generated_at", TIME),
        ),
        key=("metrics_date",), spread="ALL", order=("metrics_date",),
    ),
]

TABLES: dict[str, Table] = {t.name: t for t in _ALL}
SOURCE_TABLES = tuple(t.name for t in _ALL if t.layer == RAW)

# Where each snapshot goes when a layer is loaded.  Two sources that share a
# target are unioned before the single refresh of that target.
RAW_ROUTES = {name: name for name in SOURCE_TABLES}
CURATED_ROUTES = {
    "apartments": "curated_apartments",
    "apartment_attributes": "curated_apartment_details",
    "user_viewings": "curated_user_activity",
    "bookings": "curated_user_activity",
}


def database(layer: str, prefix: str = "") -> str:
    return f"{prefix}{layer}"


def qualified(table: str, prefix: str = "") -> str:
    return f"{database(TABLES[table].layer, prefix)}.{table}"


def create_layers(spark: SparkSession, prefix: str = "", location: str | None = None) -> list[str]:
    """Create the three databases and fourteen tables where they are missing."""
    for layer in LAYERS:
        at = f" LOCATION '{location.rstrip('/')}/{layer}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database(layer, prefix)}{at}")
    created = []
    for table in TABLES.values():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
        parts = f" PARTITIONED BY ({', '.join(table.partition_by)})" if table.partition_by else ""
        name = qualified(table.name, prefix)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts}")
        created.append(name)
    return created
