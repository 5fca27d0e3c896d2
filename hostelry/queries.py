"""The registered queries: each reads whole tables of one data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from datetime import datetime, timedelta
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.columns import city_label, fixed_decimals, period_start
from .operators import curated, enrich, facts, quality
from .operators.conform import conform, lost_values, truncate_columns
from .operators.distribution import binned_density
from .operators.history import known_per_period, validity
from .operators.periods import booked_nights, latest, lookback
from .operators.ranking import first_rows
from .operators.repeat import rolling_repeat
from .plans import engagement, insights, jobs, kpis, rental
from .schemas import SOURCE_TABLES, TABLES, create_layers, qualified
from .session import configure, scratch_path
from .sources import hot_keys, manifest
from .sources.csv import CSV_FILES, read_seed
from .sources.json_rows import rows_to_json
from .sources.sample_tables import base_table, damaged_table, source_table
from .sources.snapshots import read_history, read_latest, write_snapshot
from .sources.tables import refresh_table, replace_table, spread_evenly, write_bucketed

AS_OF = datetime(2001, 12, 31)
EARLIER = datetime(2001, 12, 30)
LOOKBACK_AS_OF = datetime(1998, 6, 30)
LOOKBACK_DAYS = 30
# Activity that the refresh queries load late.
LATE_FROM, LATE_TO = "1997-03-05 00:00:00", "1997-04-10 00:00:00"
# Snapshots of the listings that the history queries take: every 20 days from the first.
FIRST_SNAPSHOT, SNAPSHOT_DAYS, SNAPSHOTS = datetime(1998, 1, 1), 20, 6
TITLE_BYTES = 255
# A money or count column of every table that the pipeline stores.
STORED_TOTALS = {
    "apartments": "price", "apartment_attributes": "square_feet", "user_viewings": "user_id",
    "bookings": "total_price", "curated_apartments": "price",
    "curated_apartment_details": "square_feet", "curated_user_activity": "total_price",
    "presentation_metrics": "total_booking_value",
    "pres_rental_performance_weekly": "total_active_listings",
    "pres_rental_performance_monthly": "total_active_listings",
    "pres_popular_locations_weekly": "total_bookings", "pres_top_listings_weekly": "total_revenue",
    "pres_user_engagement_weekly": "total_bookings", "pres_user_booking_history": "total_spend",
}


class Data:
    """The tables of one folder at every stage, built on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder

    def base(self, name: str) -> DataFrame:
        return base_table(self.spark, self.folder, name)

    def raw(self, table: str) -> DataFrame:
        return source_table(self.spark, self.folder, table)

    def enriched(self, table: str) -> DataFrame:
        return jobs.ENRICHMENTS[table](self.raw(table), AS_OF)

    @cached_property
    def apartments(self) -> DataFrame:
        return curated.curated_apartments(self.enriched("apartments"), AS_OF)

    @cached_property
    def details(self) -> DataFrame:
        return curated.curated_details(
            self.enriched("apartment_attributes"), self.raw("apartments"), AS_OF
        )

    @cached_property
    def activity(self) -> DataFrame:
        return curated.user_activity(
            self.enriched("user_viewings"), self.enriched("bookings"), AS_OF
        )

    @property
    def places(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self.apartments, self.details, self.activity

    def performance(self, grain: str = "week") -> DataFrame:
        return rental.rental_performance(*self.places, grain)

    def engagement(self) -> DataFrame:
        return engagement.user_engagement(self.activity)

    def history(self) -> DataFrame:
        return engagement.user_booking_history(self.activity, self.details)

    def latest_week(self, df: DataFrame):
        return latest(df, period_start(F.col("activity_date")))

    def latest_history(self) -> DataFrame:
        """Booking history of the latest week only; older bookings are not read."""
        since = self.latest_week(rental.bookings_of(self.activity))
        return engagement.user_booking_history(self.activity, self.details, since=since)

    def latest_listing_weeks(self) -> DataFrame:
        since = self.latest_week(rental.confirmed_of(self.activity))
        return rental.top_listings(*self.places, since=since)


def _enrich_viewings_timed(d: Data) -> DataFrame:
    hours = F.make_interval(hours=F.col("id") % 90)
    ended = d.raw("user_viewings").withColumn(
        "viewing_end_time", F.when(F.col("id") % 7 != 0, F.col("viewed_at") + hours)
    )
    by_day = enrich.enrich_viewings(ended, AS_OF)
    both = enrich.enrich_viewings(
        by_day.withColumnRenamed("viewing_duration_seconds", "day_seconds"), AS_OF, exact=True
    )
    return both.select("id", "day_seconds", F.col("viewing_duration_seconds").alias("exact_seconds"))


def _presentation_metrics(d: Data) -> DataFrame:
    frames = [d.enriched(t) for t in ("apartments", "user_viewings", "bookings")]
    return kpis.presentation_metrics(*frames, AS_OF)


def _top5_city_pivot(d: Data) -> DataFrame:
    return insights.ranked_city_trends(rental.popular_locations(*d.places))


def _top_cities_latest(d: Data) -> DataFrame:
    since = d.latest_week(d.activity)
    return insights.top_cities_latest(rental.popular_locations(*d.places, since=since))


def _price_display(d: Data) -> DataFrame:
    shown = insights.price_summary(d.performance())
    return shown.select(
        *[fixed_decimals(F.col(c), 2).alias(c) for c in ("avg_value", "max_value", "min_value", "trend")],
        fixed_decimals(F.col("trend_pct"), 1).alias("trend_pct"),
    )


def _city_labels(d: Data) -> DataFrame:
    label = city_label(F.col("city"), F.col("state")).alias("place")
    return d.details.groupBy(label).agg(F.count(F.lit(1)).alias("n_listings"))


def _week_bucket_sunday(d: Data) -> DataFrame:
    week = period_start(F.col("booking_date"), "week", "SUN").alias("week_start_date")
    return d.raw("bookings").groupBy(week).agg(F.count(F.lit(1)).alias("n_bookings"))


def _dq_pk_duplicates(d: Data) -> DataFrame:
    return quality.duplicate_keys(d.base("lineitem"), ["l_orderkey", "l_linenumber"])


def _dq_unique(d: Data) -> DataFrame:
    parts = [
        quality.unique_key(d.raw("bookings"), ["booking_id"], "unique"),
        quality.unique_key(d.base("lineitem"), ["l_orderkey", "l_linenumber"]),
        quality.unique_key(d.base("orders"), ["o_custkey"], "unique"),
    ]
    return reduce(DataFrame.unionByName, parts)


def _dq_fk_orphans(d: Data) -> DataFrame:
    listings = d.raw("apartments")
    parts = [
        quality.foreign_key(d.raw("bookings"), "apartment_id", listings, "id"),
        quality.foreign_key(d.base("lineitem"), "l_orderkey", d.base("orders"), "o_orderkey"),
        quality.foreign_key(d.base("labels"), "doc_id", d.base("documents"), "doc_id"),
        # Listings that nobody booked, seen as keys without a booking.
        quality.foreign_key(listings, "id", d.raw("bookings"), "apartment_id"),
    ]
    return reduce(DataFrame.unionByName, parts)


def _unbooked_listings(d: Data) -> DataFrame:
    return quality.orphans(d.raw("apartments"), "id", d.raw("bookings"), "apartment_id")


def _titled_documents(d: Data) -> DataFrame:
    return d.base("documents").select("doc_id", F.col("text").alias("title"))


def _dq_varchar_overflow(d: Data) -> DataFrame:
    own = quality.max_length(d.raw("apartments"), TABLES["apartments"].text_limits)
    documents = quality.max_length(_titled_documents(d), {"title": TITLE_BYTES})
    return own.unionByName(documents)


def _dq_report(d: Data) -> DataFrame:
    """Of tables that break some constraints here and there."""
    frames = {t: damaged_table(d.spark, d.folder, t) for t in SOURCE_TABLES}
    return quality.report(frames, TABLES)


def _lost_values(d: Data) -> DataFrame:
    """Guest counts as text, some with a decimal point and some not a number."""
    texts = d.raw("bookings").select(
        "id", "booking_status", "booking_date",
        F.when(F.col("id") % 3 == 0, F.col("num_guests").cast("string"))
        .when(F.col("id") % 3 == 1, F.concat(F.col("num_guests").cast("string"), F.lit(".0")))
        .otherwise(F.col("booking_status")).alias("num_guests"),
    )
    return lost_values(texts, TABLES["bookings"])


def _latest_period_filter(d: Data) -> DataFrame:
    week = period_start(F.col("booking_date"))
    return insights.latest_week(d.raw("bookings"), week).select(
        "id", week.alias("week_start_date"), "total_price"
    )


def _repeat_customers(d: Data) -> DataFrame:
    return insights.customers_by_kind(d.history())[0].select("user_id", "week_start_date", "total_spend")


def _snapshot_roundtrip(d: Data) -> DataFrame:
    root = scratch_path(d.spark, "snapshots")
    bookings = d.raw("bookings")
    write_snapshot(bookings.where("booking_status = 'pending'"), root, "bookings", EARLIER)
    write_snapshot(bookings, root, "bookings", AS_OF)
    return read_latest(d.spark, root, "bookings").select("id", "user_id", "booking_date", "total_price")


def _own_layers(d: Data) -> str:
    prefix = f"q{uuid.uuid4().hex[:12]}_"
    create_layers(d.spark, prefix, scratch_path(d.spark, "layers"))
    return prefix


def _table_refresh(d: Data) -> DataFrame:
    """Two refreshes in a row leave the rows of the second."""
    prefix = _own_layers(d)
    bookings = d.raw("bookings")
    refresh_table(bookings.where("booking_status = 'pending'"), "bookings", EARLIER, prefix)
    refresh_table(bookings, "bookings", AS_OF, prefix)
    return d.spark.table(qualified("bookings", prefix)).select(
        "id", "apartment_id", "booking_date", "total_price", "currency", "etl_inserted_at"
    )


def _csv_roundtrip(d: Data) -> DataFrame:
    folder = scratch_path(d.spark, "csv")
    for table in ("bookings", "apartments"):
        path = f"{folder}/{CSV_FILES[table]}"
        d.raw(table).write.option("escape", '"').csv(path, header=True)
    booked = read_seed(d.spark, folder, "bookings", multi_line=False)
    listed = read_seed(d.spark, folder, "apartments", multi_line=False)
    return booked.join(listed.select(F.col("id").alias("apartment_id"), "title", "is_active"),
                       "apartment_id", "left").select(
        "id", "apartment_id", "booking_date", "total_price", "currency", "title", "is_active"
    )


def _load_audit(d: Data) -> DataFrame:
    status = jobs.extract(d.spark, d.raw, scratch_path(d.spark, "raw"), AS_OF)
    return status.select("table", "status", "rows")


def _pipeline_e2e(d: Data) -> DataFrame:
    """The whole chain; answers with the rows and a total of every table it stored."""
    roots = [scratch_path(d.spark, name) for name in ("raw", "processed", "metrics")]
    prefix = f"q{uuid.uuid4().hex[:12]}_"
    jobs.run_pipeline(
        d.spark, d.raw, jobs.Lake(*roots, prefix), AS_OF, scratch_path(d.spark, "layers")
    )
    return _totals(d, prefix, STORED_TOTALS)


def _totals(d: Data, prefix: str, tables: Iterable[str]) -> DataFrame:
    """Rows and the total of a column of each stored table."""
    parts = []
    for table in tables:
        total = F.sum(F.col(STORED_TOTALS[table]).cast("decimal(18,2)")).cast("double")
        rows = d.spark.table(qualified(table, prefix)).agg(F.count(F.lit(1)).alias("rows"), total.alias("total"))
        parts.append(rows.select(F.lit(table).alias("table"), "rows", "total"))
    return reduce(DataFrame.unionByName, parts)


def _refreshed(d: Data) -> str:
    """Layers whose presentation was built without some activity, which was then merged in."""
    prefix = _own_layers(d)
    at = F.col("activity_date")
    is_late = F.coalesce(
        (at >= F.lit(LATE_FROM).cast("timestamp")) & (at < F.lit(LATE_TO).cast("timestamp")) & (F.col("source_id") % 3 == 0), F.lit(False)
    )
    refresh_table(d.apartments, "curated_apartments", AS_OF, prefix)
    refresh_table(d.details, "curated_apartment_details", AS_OF, prefix)
    refresh_table(curated.with_activity_ids(d.activity.where(~is_late)), "curated_user_activity", AS_OF, prefix)
    jobs.require_ok("presentation", jobs.build_presentation(d.spark, AS_OF, prefix))
    jobs.require_ok("refresh", jobs.refresh_presentation(d.spark, d.activity.where(is_late), AS_OF, prefix))
    return prefix


def _partial_refresh(d: Data) -> DataFrame:
    """Rows and totals of the tables that late activity changes."""
    tables = [t for t in STORED_TOTALS if t.startswith("pres_") or t == "curated_user_activity"]
    return _totals(d, _refreshed(d), tables)


def _refreshed_history(d: Data) -> DataFrame:
    return d.spark.table(qualified("pres_user_booking_history", _refreshed(d))).drop("etl_inserted_at")


def _users_by_quarter(d: Data) -> DataFrame:
    """Users per quarter, counted, and whether the merged weekly sketches tell them within three standard errors."""
    week = period_start(F.col("activity_date"))
    known = d.activity.where(F.col("activity_date").isNotNull())
    counted = known.groupBy(F.to_date(F.date_trunc("quarter", week)).alias("period")).agg(F.countDistinct("user_id").alias("users"))
    sketches = facts.USER_WEEKS.of(facts.USER_DAYS.of(d.activity))
    told = facts.users_between(sketches, "quarter").withColumnRenamed("users", "estimate")
    error = 3 * 1.04 / 2 ** (facts.SKETCH_BITS / 2)
    near = F.abs(F.col("estimate") - F.col("users")) <= F.lit(error) * F.col("users")
    return counted.join(told, "period").select("period", "users", near.alias("within_error"))


def _csv_seed(d: Data) -> DataFrame:
    """Seed files to source tables, with the row count of each."""
    folder = scratch_path(d.spark, "seed")
    for table, name in CSV_FILES.items():
        d.raw(table).write.option("escape", '"').csv(f"{folder}/{name}", header=True)
    database = f"q{uuid.uuid4().hex[:12]}_source"
    place = scratch_path(d.spark, "source")
    jobs.require_ok("seed", jobs.seed_from_csv(d.spark, folder, database, place))
    counts = [
        quality.row_count(d.spark.table(f"{database}.{t}")).select(F.lit(t).alias("table"), "n_rows")
        for t in SOURCE_TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


def _sorted_table_range(d: Data) -> DataFrame:
    """A date range of a table whose files are ordered by date."""
    prefix = _own_layers(d)
    refresh_table(d.raw("bookings"), "bookings", AS_OF, prefix, arrange=True)
    stored = lookback(d.spark.table(qualified("bookings", prefix)), "booking_date", LOOKBACK_AS_OF,
                      LOOKBACK_DAYS)
    return stored.select("id", "apartment_id", "booking_date", "total_price")


def _numeric_summary(d: Data) -> DataFrame:
    numbers = d.raw("bookings").select("id", "user_id", "num_guests", "total_price")
    return quality.numeric_summary(numbers)


def _bucketed_join(d: Data) -> DataFrame:
    """Spend per listing over two tables bucketed on the listing: no shuffle to join.

    Bookings are reduced per listing inside their bucket first, so the join sees one row of
    a popular listing.  There are as many buckets as shuffle partitions.
    """
    buckets = int(d.spark.conf.get("spark.sql.shuffle.partitions"))
    prefix = _own_layers(d)
    names = {}
    for table, key in (("bookings", "apartment_id"), ("apartment_attributes", "apartment_id")):
        names[table] = f"{qualified(table, prefix)}_bucketed"
        write_bucketed(d.raw(table).withColumn("k", F.col(key)), names[table], "k", buckets)
    bookings, details = (d.spark.table(names[t]) for t in ("bookings", "apartment_attributes"))
    spent = F.sum(F.col("total_price").cast("decimal(18,2)")).cast("double")
    per_listing = bookings.groupBy("k").agg(F.count(F.lit(1)).alias("n_bookings"), spent.alias("spend"))
    return per_listing.join(details.select("k", "cityname").hint("merge"), "k").select(
        F.col("k").alias("apartment_id"), "cityname", "n_bookings", "spend"
    )


def _hot_key_join(d: Data) -> DataFrame:
    """Every booking with the viewings of its user, over stored tables that split the hot users."""
    buckets = int(d.spark.conf.get("spark.sql.shuffle.partitions"))
    prefix = _own_layers(d)
    bookings, viewings = (f"{qualified(t, prefix)}_by_user" for t in ("bookings", "user_viewings"))
    per_user = d.raw("user_viewings").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_viewings"))
    booked = d.raw("bookings").select("id", "user_id", "total_price")
    hot_keys.write_pair(booked, per_user, "user_id", buckets, bookings, viewings)
    return hot_keys.join_salted(d.spark.table(bookings), d.spark.table(viewings), "user_id", "left")


def _published(d: Data) -> str:
    """Two published snapshots of the bookings, the second with more columns, and one that was interrupted."""
    root = scratch_path(d.spark, "published")
    bookings = d.raw("bookings").select("id", "user_id", "booking_date", "total_price", "currency")
    manifest.write_published(bookings.drop("currency"), root, "bookings", EARLIER, "booking_date")
    manifest.write_published(bookings, root, "bookings", AS_OF, "booking_date")
    manifest.stage(bookings.where("id % 2 = 0"), root, "bookings", AS_OF)
    return root


def _published_snapshot(d: Data) -> DataFrame:
    return manifest.read_published(d.spark, _published(d), "bookings")


def _manifest_totals(d: Data) -> DataFrame:
    """Rows and extremes of the snapshot, from its manifest alone."""
    return manifest.manifest(d.spark, _published(d), "bookings").agg(
        F.sum("rows").alias("n_rows"), F.min("least").alias("oldest"), F.max("greatest").alias("newest")
    )


def _listing_snapshots(d: Data) -> DataFrame:
    """Stored snapshots of all listings, in which some are missing or change their flag or price."""
    root = scratch_path(d.spark, "listing_snapshots")
    listed = d.raw("apartments").select("id", "is_active", "price")
    for k in range(SNAPSHOTS):
        seen = listed.where(F.col("id") % 7 != k).select(
            "id", (F.col("is_active") & ((F.col("id") + k) % 5 != 0)).alias("is_active"),
            F.when((F.col("id") % 3 == 0) & F.lit(k >= 3), F.col("price") * 2).otherwise(F.col("price")).alias("price"),
        )
        write_snapshot(seen, root, "apartments", FIRST_SNAPSHOT + timedelta(days=SNAPSHOT_DAYS * k))
    stamped = read_history(d.spark, root, "apartments")
    return stamped.withColumn("taken", F.to_timestamp("run_ts", "yyyyMMdd_HHmmss")).drop("run_ts")


def _listing_validity(d: Data) -> DataFrame:
    return validity(_listing_snapshots(d), "id", ["is_active", "price"], "taken")


def _active_as_known(d: Data) -> DataFrame:
    """Active listings per week as they were known at its end, beside those that the newest snapshot calls active."""
    snapshots = _listing_snapshots(d)
    active = validity(snapshots, "id", ["is_active"], "taken").where("is_active")
    now = active.where("valid_to IS NULL").agg(F.count(F.lit(1)).alias("active_now")).scalar()
    return known_per_period(active, snapshots.agg(F.max("taken"))).select(
        F.col("period").alias("week_start_date"), F.col("known").alias("active_as_known"), now.alias("active_now")
    )


def _price_density(d: Data) -> DataFrame:
    """The density of all booking prices, per million of the currency."""
    density = binned_density(d.raw("bookings"), "total_price")
    return density.select("point", "x", (F.col("density") * 1e6).alias("density"))


def _dq_limits(d: Data) -> DataFrame:
    """The report of the damaged tables under limits of their own for three kinds of checks."""
    frames = {t: damaged_table(d.spark, d.folder, t) for t in SOURCE_TABLES}
    return quality.report(frames, TABLES, {"primary_key": 0.02, "not_null": 0.1, "max_length": 0.05}, 0.5)


def _flat_snapshot(d: Data) -> DataFrame:
    """Files directly in a table's folder, without a snapshot level."""
    root = scratch_path(d.spark, "flat")
    d.raw("bookings").write.parquet(f"{root}/bookings")
    return read_latest(d.spark, root, "bookings", allow_flat=True).select("id", "user_id", "total_price")


def _even_table(d: Data) -> DataFrame:
    """A table dealt evenly over its files, whatever its keys."""
    prefix = _own_layers(d)
    name = qualified("apartment_attributes", prefix)
    replace_table(spread_evenly(d.raw("apartment_attributes"), 4), f"{name}_even")
    return d.spark.table(f"{name}_even").select("id", "cityname", "square_feet")


def _constant_currency(d: Data) -> DataFrame:
    return enrich.with_constant_currency(d.raw("bookings"), "EUR").select("id", "currency")


_BUILDERS: dict[str, Callable[[Data], DataFrame]] = {
    "enrich_apartments": lambda d: d.enriched("apartments"),
    "enrich_viewings": lambda d: d.enriched("user_viewings"),
    "enrich_viewings_timed": _enrich_viewings_timed,
    "enrich_bookings": lambda d: d.enriched("bookings"),
    "enrich_attributes": lambda d: d.enriched("apartment_attributes"),
    "constant_currency": _constant_currency,
    "listing_kpis": lambda d: kpis.listing_kpis(d.enriched("apartments")),
    "viewing_kpis": lambda d: kpis.viewing_kpis(d.enriched("user_viewings"), distinct_users=True),
    "booking_kpis": lambda d: kpis.booking_kpis(d.enriched("bookings")),
    "presentation_metrics": _presentation_metrics,
    "curated_apartments": lambda d: d.apartments,
    "curated_details": lambda d: d.details,
    "user_activity_union": lambda d: d.activity,
    "user_activity_with_id": lambda d: curated.with_activity_ids(d.activity),
    "rental_performance_weekly": lambda d: d.performance("week"),
    "rental_performance_monthly": lambda d: d.performance("month"),
    "popular_locations_weekly": lambda d: rental.popular_locations(*d.places),
    "top_listings_weekly": lambda d: rental.top_listings(*d.places),
    "user_engagement_weekly": lambda d: d.engagement(),
    "weekly_active_users": lambda d: engagement.weekly_active_users(d.activity),
    "user_booking_history": lambda d: d.history(),
    "price_summary": lambda d: insights.price_summary(d.performance()),
    "price_summary_display": _price_display,
    "occupancy_summary": lambda d: insights.occupancy_summary(d.performance()),
    "top_cities_latest": _top_cities_latest,
    "top5_city_pivot": _top5_city_pivot,
    "top_listings_latest": lambda d: insights.top_listings_latest(d.latest_listing_weeks()),
    "corr_occupancy_revenue": lambda d: insights.occupancy_revenue_correlation(
        d.latest_listing_weeks()
    ),
    "bookings_per_user_summary": lambda d: insights.bookings_per_user_summary(d.engagement()),
    "booking_count_distribution": lambda d: insights.booking_count_distribution(d.latest_history()),
    "booking_histogram": lambda d: insights.booking_histogram(d.latest_history()),
    "booking_histogram_all_weeks": lambda d: insights.booking_histogram(d.history()),
    "booking_kde": lambda d: insights.booking_kde(d.latest_history()),
    "booking_kde_all_weeks": lambda d: insights.booking_kde(d.history()),
    "duration_summary": lambda d: insights.duration_summary(d.engagement()),
    "corr_duration_spend": lambda d: insights.duration_spend_correlation(d.latest_history()),
    "repeat_rate_summary": lambda d: insights.repeat_rate_summary(d.engagement()),
    "repeat_vs_onetime": lambda d: insights.repeat_comparison(d.latest_history()),
    "repeat_customers": _repeat_customers,
    "activity_rate": lambda d: insights.activity_rate(d.engagement()),
    "avg_activity_rate": lambda d: insights.average_activity_rate(d.engagement()),
    "city_labels": _city_labels,
    "lookback_activity": lambda d: lookback(
        d.activity, "activity_date", LOOKBACK_AS_OF, LOOKBACK_DAYS
    ),
    "week_bucket_sunday": _week_bucket_sunday,
    "booked_nights": lambda d: booked_nights(rental.confirmed_of(d.activity)),
    "rolling_repeat": lambda d: rolling_repeat(
        d.raw("bookings").select("id", "user_id", "booking_date")
    ),
    "dq_not_null": lambda d: quality.not_null(d.raw("apartment_attributes"), ["id", "square_feet", "fee"]),
    "dq_pk_duplicates": _dq_pk_duplicates,
    "dq_unique": _dq_unique,
    "dq_fk_orphans": _dq_fk_orphans,
    "unbooked_listings": _unbooked_listings,
    "dq_varchar_overflow": _dq_varchar_overflow,
    "dq_report": _dq_report,
    "type_conformance": lambda d: conform(
        d.raw("bookings").select(*[F.col(c).cast("string").alias(c) for c in TABLES["bookings"].schema.names]),
        TABLES["bookings"],
    ),
    "lost_values": _lost_values,
    "profile_columns": lambda d: quality.profile(d.raw("apartment_attributes")),
    "numeric_summary": _numeric_summary,
    "first_bookings": lambda d: first_rows(d.raw("bookings"), ["id"], 10),
    "row_count": lambda d: quality.row_count(d.raw("bookings")),
    "truncate_columns": lambda d: truncate_columns(_titled_documents(d), {"title": TITLE_BYTES}),
    "latest_period_filter": _latest_period_filter,
    "rows_to_json": lambda d: rows_to_json(d.raw("bookings").select(
        "id", "user_id", "booking_date", "booking_status", "num_guests", "etl_inserted_at"
    )),
    "snapshot_roundtrip": _snapshot_roundtrip,
    "table_refresh": _table_refresh,
    "csv_roundtrip": _csv_roundtrip,
    "load_audit": _load_audit,
    "pipeline_e2e": _pipeline_e2e,
    "partial_refresh": _partial_refresh,
    "refreshed_history": _refreshed_history,
    "users_by_quarter": _users_by_quarter,
    "csv_seed": _csv_seed,
    "flat_snapshot": _flat_snapshot,
    "even_table": _even_table,
    "bucketed_join": _bucketed_join,
    "hot_key_join": _hot_key_join,
    "price_density": _price_density,
    "dq_report_limits": _dq_limits,
    "published_snapshot": _published_snapshot,
    "manifest_totals": _manifest_totals,
    "listing_validity": _listing_validity,
    "active_as_known": _active_as_known,
    "sorted_table_range": _sorted_table_range,
}


# Answers with sums of floating-point numbers, whose last digits depend on the
# order of the additions.  They are shown to six decimals, all others in full.
ROUNDED = {
    "rental_performance_weekly", "rental_performance_monthly", "price_summary",
    "occupancy_summary", "corr_occupancy_revenue", "bookings_per_user_summary",
    "booking_count_distribution", "booking_histogram", "booking_histogram_all_weeks",
    "booking_kde", "booking_kde_all_weeks", "numeric_summary", "duration_summary", "corr_duration_spend",
    "repeat_rate_summary", "repeat_vs_onetime", "dq_report", "dq_report_limits", "price_density", "activity_rate", "avg_activity_rate",
}


def comparable(df: DataFrame, rounded: bool = False) -> DataFrame:
    """Timestamps as plain UTC wall-clock values, floats optionally to six decimals."""
    out = []
    for f in df.schema:
        value = f"`{f.name}`"
        if isinstance(f.dataType, T.TimestampType):
            value = f"CAST({value} AS TIMESTAMP_NTZ)"
        elif rounded and isinstance(f.dataType, T.DoubleType):
            value = f"round({value}, 6)"
        out.append(f"{value} AS `{f.name}`")
    return df.selectExpr(*out)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def query(name: str, build: Callable[[Data], DataFrame]):
        return lambda spark, folder: comparable(build(Data(spark, folder)), name in ROUNDED)

    return {name: query(name, build) for name, build in _BUILDERS.items()}
