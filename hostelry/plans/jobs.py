"""End-to-end jobs: extract, transform, load, metrics, presentation."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import period_start
from ..operators import facts
from ..operators.conform import conform
from ..operators.curated import (
    curated_apartments, curated_details, user_activity, with_activity_ids,
)
from ..operators.enrich import (
    enrich_apartments, enrich_attributes, enrich_bookings, enrich_viewings,
)
from ..operators.periods import lookback
from ..schemas import CURATED_ROUTES, RAW_ROUTES, SOURCE_TABLES, TABLES, create_layers, qualified
from ..session import configure, materialize
from ..sources.csv import FREE_TEXT, read_seed
from ..sources.snapshots import Audit, read_latest, write_snapshot
from ..sources.tables import refresh_table, replace_table
from . import engagement, rental
from .kpis import presentation_metrics

ENRICHMENTS: dict[str, Callable[[DataFrame, datetime], DataFrame]] = {
    "apartments": enrich_apartments,
    "apartment_attributes": enrich_attributes,
    "user_viewings": enrich_viewings,
    "bookings": enrich_bookings,
}

# Time column that bounds an incremental extract.
TIME_COLUMNS = {
    "apartments": "listing_created_on",
    "user_viewings": "viewed_at",
    "bookings": "booking_date",
}

REPEAT_DAYS = 30  # a booking this soon after another makes a repeat customer
# Weekly tables of a bounded number of rows a week.
CARRIED_OVER = ("pres_popular_locations_weekly", "pres_top_listings_weekly")
# The weekly table of users, some figures of which run on over the weeks.
RUNNING = "pres_user_engagement_weekly"
STATUS_SCHEMA = "table string, status string, rows bigint, target string, error string"


@dataclass(frozen=True)
class Lake:
    """Where one pipeline keeps its data.  ``prefix`` names its databases apart."""

    raw_root: str
    processed_root: str
    metrics_root: str
    prefix: str = ""


class StepFailed(RuntimeError):
    """At least one table of a step failed."""


Sink = Callable[[DataFrame, str], Audit]


def fan_out(
    spark: SparkSession, names: Iterable[str], step: Callable[[str], Audit], parallel: int = 4
) -> DataFrame:
    """Run ``step`` per table, ``parallel`` tables at a time; rows in the order of ``names``.

    A failure is recorded and the others still run.
    """

    def one(name: str) -> tuple:
        try:
            done = step(name)
            return name, "ok", done.rows, done.path, None
        except Exception as error:  # noqa: BLE001 - reported as a status row
            return name, "failed", None, None, f"{type(error).__name__}: {error}"

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        rows = list(pool.map(one, names))
    return spark.createDataFrame(rows, STATUS_SCHEMA)


def _put(
    df: DataFrame, table: str, as_of: datetime, prefix: str, sink: Sink | None, arrange: bool = False
) -> Audit:
    return refresh_table(df, table, as_of, prefix, arrange) if sink is None else sink(df, table)


def require_ok(step: str, status: DataFrame) -> DataFrame:
    """Raise when a table of the step failed; one row per table at most."""
    failed = status.where("status <> 'ok'").collect()
    if failed:
        raise StepFailed(f"{step}: " + "; ".join(f"{r['table']}: {r['error']}" for r in failed))
    return status


def extract(
    spark: SparkSession, reader: Callable[[str], DataFrame], raw_root: str, as_of: datetime,
    tables: Iterable[str] = SOURCE_TABLES, days: dict[str, int] | None = None,
) -> DataFrame:
    """Source tables to raw snapshots.  ``days`` limits tables to a look-back."""

    def one(table: str) -> Audit:
        df = reader(table)
        if days and table in days:
            df = lookback(df, TIME_COLUMNS[table], as_of, days[table])
        return write_snapshot(df, raw_root, table, as_of)

    return fan_out(spark, tables, one)


def transform_all(
    spark: SparkSession, raw_root: str, processed_root: str, as_of: datetime
) -> DataFrame:
    """Latest raw snapshots to processed snapshots."""

    def one(table: str) -> Audit:
        enriched = ENRICHMENTS[table](read_latest(spark, raw_root, table), as_of)
        return write_snapshot(enriched, processed_root, table, as_of)

    return fan_out(spark, ENRICHMENTS, one)


def load_raw(
    spark: SparkSession, raw_root: str, as_of: datetime, prefix: str = "", sink: Sink | None = None
) -> DataFrame:
    """Latest raw snapshots to the raw layer, one table each.

    Here and below ``sink(rows, table)`` may take the rows of a table elsewhere, such as to
    a JDBC warehouse; without it they replace the table of the Spark catalog.
    """

    def one(source: str) -> Audit:
        df = read_latest(spark, raw_root, source, allow_flat=True)
        return _put(df, RAW_ROUTES[source], as_of, prefix, sink)

    return fan_out(spark, RAW_ROUTES, one)


def load_curated(
    spark: SparkSession, processed_root: str, as_of: datetime, prefix: str = "", sink: Sink | None = None
) -> DataFrame:
    """Latest processed snapshots to the curated layer.  Viewings and bookings
    share a target and are loaded together; their ids already follow the time
    order, so only the two listing tables are arranged here."""

    def build(target: str) -> DataFrame:
        sources = [s for s, t in CURATED_ROUTES.items() if t == target]
        frames = [read_latest(spark, processed_root, s) for s in sources]
        if target == "curated_apartments":
            return curated_apartments(*frames, as_of)
        if target == "curated_apartment_details":
            return curated_details(*frames, read_latest(spark, processed_root, "apartments"), as_of)
        return with_activity_ids(user_activity(*frames, as_of))

    targets = dict.fromkeys(CURATED_ROUTES.values())

    def one(target: str) -> Audit:
        arrange = target != "curated_user_activity"
        return _put(build(target), target, as_of, prefix, sink, arrange)

    return fan_out(spark, targets, one)


def generate_metrics(
    spark: SparkSession, processed_root: str, metrics_root: str, as_of: datetime,
    prefix: str = "", days: int | None = None, sink: Sink | None = None,
) -> DataFrame:
    """The KPI row as a snapshot and in the presentation layer.  It is computed
    once; the table is loaded from the stored row.  ``days`` limits the activity
    to a look-back."""

    def source(table: str) -> DataFrame:
        df = read_latest(spark, processed_root, table)
        if days is None or table == "apartments":
            return df
        return lookback(df, TIME_COLUMNS[table], as_of, days)

    def one(table: str) -> Audit:
        frames = [source(t) for t in ("apartments", "user_viewings", "bookings")]
        write_snapshot(presentation_metrics(*frames, as_of), metrics_root, table, as_of)
        return _put(read_latest(spark, metrics_root, table), table, as_of, prefix, sink)

    return fan_out(spark, ["presentation_metrics"], one)


def _datasets(spark: SparkSession, prefix: str = "", weeks: list[date] | None = None) -> dict[str, Callable[[], DataFrame]]:
    """The six presentation datasets from the stored reductions and listing tables.

    With ``weeks`` the three datasets with a row per week and place, listing or user hold those
    weeks only, and only the folders around them are read.  The other three have one
    row per period and come whole; of the weekly users the figures of other weeks are those stored.
    """
    apartments, details = (spark.table(qualified(t, prefix)) for t in ("curated_apartments", "curated_apartment_details"))
    near = None if weeks is None else _periods_around(weeks)
    listing_days, user_days = facts.LISTING_DAYS.read(spark, prefix), facts.USER_DAYS.read(spark, prefix)
    some_listing_days, some_user_days = (r.read(spark, prefix, near) for r in (facts.LISTING_DAYS, facts.USER_DAYS))
    active = (F.col("bookings") > 0) | (F.col("viewings") > 0)
    week = period_start(F.col("day")).alias("week_start_date")
    offered = rental.supply(apartments, details)

    def of_weeks(df: DataFrame) -> DataFrame:
        return df if weeks is None else df.where(F.col("week_start_date").isin(weeks))

    def performance(grain: str) -> DataFrame:
        last = listing_days.where(active).agg(period_start(F.max("day"), grain).alias("last"))
        nights = facts.night_parts(listing_days, grain)
        return rental.performance_of(apartments, details, nights, last, grain, stored=offered)

    def users() -> DataFrame:
        some = facts.user_days_of(some_user_days)
        if weeks is None:
            return engagement.engagement_of(some, REPEAT_DAYS)
        first_days = user_days.groupBy("user_id").agg(F.min("day").alias("day"))
        return engagement.engagement_after(spark.table(qualified(RUNNING, prefix)), some, first_days, weeks, REPEAT_DAYS)

    def locations() -> DataFrame:
        counted = some_listing_days.where(active).groupBy(week, "apartment_id").agg(
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("bookings", "viewings")]
        )
        return rental.locations_of(apartments, details, of_weeks(counted))

    return {
        "pres_rental_performance_weekly": lambda: performance("week"),
        "pres_rental_performance_monthly": lambda: performance("month"),
        "pres_popular_locations_weekly": locations,
        "pres_top_listings_weekly": lambda: rental.top_of(
            apartments, details, of_weeks(facts.listing_weeks_of(some_listing_days))
        ),
        RUNNING: users,
        "pres_user_booking_history": lambda: engagement.history_of(some_user_days, details, REPEAT_DAYS, weeks=weeks),
    }


def _periods_around(weeks: list[date]) -> set[date]:
    """Folders of the reductions that hold the weeks' days and the repeat window before them."""
    days = {w + timedelta(days=d) for w in weeks for d in range(-REPEAT_DAYS, 7)}
    return {d.replace(month=d.month - (d.month - 1) % 3, day=1) for d in days}


def build_presentation(
    spark: SparkSession, as_of: datetime, prefix: str = "", sink: Sink | None = None
) -> DataFrame:
    """The six presentation datasets; the activity table is read twice, for the reductions."""
    facts.build_facts(spark, spark.table(qualified("curated_user_activity", prefix)), prefix)
    build = _datasets(spark, prefix)
    return fan_out(  # all at a time: each is bound by its few small last stages
        spark, build, lambda t: _put(build[t](), t, as_of, prefix, sink, arrange=True), len(build)
    )


def touched_weeks(late: DataFrame) -> list[date]:
    """Weeks whose rows late activity can change: its own, those of its nights, and the repeat window after it."""
    week = period_start(F.col("day")).alias("week")
    own = facts.LISTING_DAYS.of(late)
    booked = facts.night_parts(own).select(F.col("period").alias("week"))
    last = F.date_add("day", F.when(F.col("bookings") > 0, REPEAT_DAYS).otherwise(0))
    after = facts.USER_DAYS.of(late).select(F.explode(F.sequence(
        period_start(F.col("day")), period_start(last), F.expr("interval 7 days"))).alias("week"))
    weeks = own.where((F.col("bookings") > 0) | (F.col("viewings") > 0)).select(week).union(booked).union(after)
    return sorted(r[0] for r in weeks.distinct().collect())  # bounded by the calendar


def refresh_presentation(spark: SparkSession, late: DataFrame, as_of: datetime, prefix: str = "") -> DataFrame:
    """Bring the stored reductions and the presentation up to date with late activity rows.

    ``late`` has the columns of the activity table without ids, rows not loaded before.  The
    rows are appended to the activity table with ids after the last one; of the
    reductions the touched folders are replaced.  Of the datasets with a row per week and place, listing or
    user the touched weeks are computed: the history, which grows with the users, has a folder per week and
    only those are written; the other two, some rows for each week of the calendar, are written with
    their other weeks carried over.  The activity table itself is not read, but for its greatest id;
    ``late`` is computed once and stored.
    """
    late = materialize(late, "late")
    name = qualified("curated_user_activity", prefix)
    last = spark.table(name).agg(F.coalesce(F.max("activity_id"), F.lit(0)).alias("last")).first()["last"]
    rows = with_activity_ids(late).withColumn("activity_id", F.col("activity_id") + F.lit(last))
    ready = conform(rows, TABLES["curated_user_activity"])
    ready.select(*spark.table(name).columns).write.insertInto(name)
    facts.merge_late(spark, late, prefix)
    weeks = touched_weeks(late)
    build = _datasets(spark, prefix, weeks)

    def one(table: str) -> Audit:
        fresh = build[table]()
        if table in CARRIED_OVER:
            others = spark.table(qualified(table, prefix)).where(~F.col("week_start_date").isin(weeks))
            fresh = materialize(others.unionByName(fresh, allowMissingColumns=True), table)
        elif table == RUNNING:
            fresh = materialize(fresh, table)  # it reads the table that it replaces
        return _put(fresh, table, as_of, prefix, None, arrange=True)

    with facts.touched_partitions_only(spark):
        return fan_out(spark, build, one, len(build))


def seed_from_csv(
    spark: SparkSession, folder: str, database: str, location: str | None = None
) -> DataFrame:
    """CSV seed files to source tables, in a database at ``location`` if one is given.

    Only files with free text are read with quoted line breaks, one file per task; the
    activity files split.
    """
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    return fan_out(
        spark, SOURCE_TABLES,
        lambda table: replace_table(
            read_seed(spark, folder, table, multi_line=table in FREE_TEXT), f"{database}.{table}"
        ),
    )


def run_pipeline(
    spark: SparkSession, reader: Callable[[str], DataFrame], lake: Lake, as_of: datetime,
    location: str | None = None, days: dict[str, int] | None = None,
    metrics_days: int | None = None,
) -> DataFrame:
    """The whole chain in order; stops at the first step with a failed table."""
    configure(spark)
    create_layers(spark, lake.prefix, location)
    steps: dict[str, Callable[[], DataFrame]] = {
        "extract": lambda: extract(spark, reader, lake.raw_root, as_of, days=days),
        "transform": lambda: transform_all(spark, lake.raw_root, lake.processed_root, as_of),
        "load_raw": lambda: load_raw(spark, lake.raw_root, as_of, lake.prefix),
        "load_curated": lambda: load_curated(spark, lake.processed_root, as_of, lake.prefix),
        "metrics": lambda: generate_metrics(
            spark, lake.processed_root, lake.metrics_root, as_of, lake.prefix, metrics_days
        ),
        "presentation": lambda: build_presentation(spark, as_of, lake.prefix),
    }
    done = [require_ok(name, run()) for name, run in steps.items()]
    return reduce(DataFrame.unionByName, done)
