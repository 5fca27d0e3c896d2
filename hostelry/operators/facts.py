"""Mergeable reductions of the activity table, kept per quarter of their day.

Three stored tables answer all presentation datasets: what happened per listing and day with
the booked nights as month masks, what happened per user and day, and a sketch of the
users of each week.  Rows of one key merge (sums, least and greatest times, OR of masks, union of
sketches), so late activity is reduced by itself and merged into the quarters
it touches; others are not read or written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import money, period_start
from ..schemas import CURATED, database
from ..session import materialize
from ..sources.tables import into_partitions

BOOKING, VIEWING, CONFIRMED = "booking", "viewing", "confirmed"
GRAIN = "quarter"  # of the folders of the stored tables; late activity replaces whole folders
SKETCH_BITS = 14  # 2^14 registers: a relative standard error of 1.04 / sqrt(2^14), 0.8 %
_MERGES: dict[str, Callable[[str], Column]] = {
    "sum": F.sum, "min": F.min, "max": F.max, "or": F.bit_or, "union": F.hll_union_agg,
}


@dataclass(frozen=True)
class Reduction:
    """One stored table: keys (``day`` among them), measures with type and merge, and how activity gives them."""

    name: str
    keys: dict[str, str]
    measures: dict[str, tuple[str, str]]
    reduce: Callable[[DataFrame], DataFrame]
    by_period: bool = True  # or one file, for tables bounded by the calendar

    def merged(self, rows: DataFrame) -> DataFrame:
        """One row per key: rows that several reductions gave for it, put together."""
        grouped = rows.groupBy(*self.keys).agg(*[_MERGES[how](c).alias(c) for c, (_, how) in self.measures.items()])
        return self._typed(grouped)

    def of(self, activity: DataFrame) -> DataFrame:
        return self._typed(self.reduce(activity))

    def _typed(self, df: DataFrame) -> DataFrame:
        kinds = self.keys | {c: kind for c, (kind, _) in self.measures.items()}
        return df.select(*[F.col(c).cast(kind).alias(c) for c, kind in kinds.items()])

    def table(self, prefix: str = "") -> str:
        return f"{database(CURATED, prefix)}.{self.name}"

    def create(self, spark: SparkSession, prefix: str = "") -> None:
        kinds = self.keys | {c: kind for c, (kind, _) in self.measures.items()}
        columns = ", ".join(f"{c} {kind}" for c, kind in kinds.items())
        parts = ", period date) USING parquet PARTITIONED BY (period)" if self.by_period else ") USING parquet"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table(prefix)} ({columns}{parts}")

    def write(self, rows: DataFrame, prefix: str = "") -> None:
        """Replace the table, or under ``touched_partitions_only`` the periods that ``rows`` has."""
        if not self.by_period:
            rows.coalesce(1).write.insertInto(self.table(prefix), overwrite=True)
            return
        dated = rows.withColumn("period", F.trunc("day", GRAIN))
        others = [c for c in self.keys if c != "day"]
        # Periods in few files each, a long one in several.
        ranged = into_partitions(dated, "period", "day", *others).sortWithinPartitions("period", "day", *others)
        ranged.write.insertInto(self.table(prefix), overwrite=True)

    def read(self, spark: SparkSession, prefix: str = "", periods: Iterable[date] | None = None) -> DataFrame:
        """The stored rows; ``periods`` prunes the folders."""
        stored = spark.table(self.table(prefix))
        if not self.by_period:
            return stored
        return (stored if periods is None else stored.where(F.col("period").isin(sorted(periods)))).drop("period")


def _listing_days(activity: DataFrame) -> DataFrame:
    """Each row counts at its day; a confirmed stay also marks its nights in the rows of the months' first days."""
    booking = F.col("activity_type") == BOOKING
    confirmed = booking & F.coalesce(F.col("booking_status") == CONFIRMED, F.lit(False))
    checkin, checkout = F.to_date("checkin_date"), F.to_date("checkout_date")
    known = F.col("checkin_date").isNotNull() & F.col("checkout_date").isNotNull()
    stay = F.when(confirmed & known, F.col("stay_duration"))
    none = F.lit(None).cast("long")

    def entry(day: Column, counted: bool, mask: Column) -> Column:
        count = lambda c: F.when(c, F.lit(1).cast("long")) if counted else none
        revenue = F.when(confirmed, money(F.col("total_price"))) if counted else F.lit(None).cast("decimal(18,2)")
        return F.struct(
            day.alias("day"), count(booking).alias("bookings"), count(F.col("activity_type") == VIEWING).alias("viewings"),
            count(confirmed).alias("confirmed"), revenue.alias("revenue"),
            (stay.cast("long") if counted else none).alias("stay_nights"), (count(stay.isNotNull())).alias("stays"), mask.alias("mask"),
        )

    def low_bits(n: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), n) - F.lit(1).cast("long")

    def month_mask(month: Column) -> Column:
        days = F.datediff(F.add_months(month, 1), month)
        low = F.greatest(F.datediff(checkin, month), F.lit(0))
        return low_bits(F.least(F.datediff(checkout, month), days)) - low_bits(low)

    months = F.sequence(F.trunc(checkin, "month"), F.trunc(F.date_sub(checkout, 1), "month"), F.expr("interval 1 month"))
    stayed = F.coalesce(confirmed & (checkout > checkin), F.lit(False))
    nights = F.transform(months, lambda m: entry(m, False, month_mask(m)))
    own = F.array(entry(F.to_date("activity_date"), True, none))
    entries = F.when(stayed, F.concat(own, nights)).otherwise(own)
    sums = ("bookings", "viewings", "confirmed", "revenue", "stay_nights", "stays")
    return (
        activity.select("apartment_id", F.inline(entries)).where("day IS NOT NULL")
        .groupBy("apartment_id", "day")
        .agg(*[F.sum(c).alias(c) for c in sums], F.bit_or("mask").alias("mask"))
    )


def _user_days(activity: DataFrame) -> DataFrame:
    """Bookings per user, day and listing; other activity of a user's day is one row without a listing."""
    at, booking = F.col("activity_date"), F.col("activity_type") == BOOKING
    known = F.col("checkin_date").isNotNull() & F.col("checkout_date").isNotNull()
    stay = F.when(booking & known, F.col("stay_duration").cast("long"))
    confirmed_stay = F.when(F.col("booking_status") == CONFIRMED, stay)
    return (
        activity.where(at.isNotNull() & F.col("user_id").isNotNull())
        .groupBy("user_id", F.to_date(at).alias("day"), F.when(booking, F.col("apartment_id")).alias("apartment_id"))
        .agg(
            F.count_if(booking).alias("bookings"), F.min(F.when(booking, at)).alias("first_booking"),
            F.max(F.when(booking, at)).alias("last_booking"), F.sum(F.when(booking, money(F.col("total_price")))).alias("spend"),
            F.sum(stay).alias("nights"), F.count(stay).alias("stays"),
            F.sum(confirmed_stay).alias("confirmed_nights"), F.count(confirmed_stay).alias("confirmed_stays"),
        )
    )


def _user_weeks(rows: DataFrame) -> DataFrame:
    """A sketch of the users of each week, from rows of the user days."""
    return rows.groupBy(period_start(F.col("day")).alias("day")).agg(F.hll_sketch_agg("user_id", SKETCH_BITS).alias("users"))


_COUNT = ("bigint", "sum")
_MONEY = ("decimal(28,2)", "sum")
LISTING_DAYS = Reduction(
    "fact_listing_days", {"apartment_id": "bigint", "day": "date"},
    {"bookings": _COUNT, "viewings": _COUNT, "confirmed": _COUNT, "revenue": _MONEY, "stay_nights": _COUNT, "stays": _COUNT,
     "mask": ("bigint", "or")},
    _listing_days,
)
USER_DAYS = Reduction(
    "fact_user_days", {"user_id": "bigint", "day": "date", "apartment_id": "bigint"},
    {"bookings": _COUNT, "first_booking": ("timestamp", "min"), "last_booking": ("timestamp", "max"), "spend": _MONEY,
     "nights": _COUNT, "stays": _COUNT, "confirmed_nights": _COUNT, "confirmed_stays": _COUNT},
    _user_days,
)
# Reduced from rows of USER_DAYS, not from activity.
USER_WEEKS = Reduction("fact_user_weeks", {"day": "date"}, {"users": ("binary", "union")}, _user_weeks, by_period=False)
REDUCTIONS = (LISTING_DAYS, USER_DAYS, USER_WEEKS)


@contextmanager
def touched_partitions_only(spark: SparkSession):
    """Overwrites replace only the partitions that the new rows have; the old setting comes back."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def build_facts(spark: SparkSession, activity: DataFrame, prefix: str = "") -> None:
    """All three tables from the whole activity, which is read twice."""
    for reduction in REDUCTIONS:
        reduction.create(spark, prefix)
    with ThreadPoolExecutor(max_workers=2) as pool:  # two tables at a time; errors are raised here
        list(pool.map(lambda r: r.write(r.of(activity), prefix), (LISTING_DAYS, USER_DAYS)))
    USER_WEEKS.write(USER_WEEKS.of(USER_DAYS.read(spark, prefix)), prefix)


def periods_of(rows: DataFrame) -> list[date]:
    """The folders of a frame with ``day``: bounded by the calendar."""
    return sorted(r[0] for r in rows.select(F.trunc("day", GRAIN)).distinct().collect() if r[0])


def merge_late(spark: SparkSession, late: DataFrame, prefix: str = "") -> None:
    """Put late activity into the stored tables; only the periods it touches are read and replaced.

    Every late row must be new: a row given twice counts twice.
    """
    with touched_partitions_only(spark):
        for reduction, source in ((LISTING_DAYS, late), (USER_DAYS, late), (USER_WEEKS, USER_DAYS.of(late))):
            partial = reduction.of(source)
            stored = reduction.read(spark, prefix, periods_of(partial))
            rows = reduction.merged(stored.unionByName(partial))
            # A table without folders is replaced whole, which must not read it meanwhile.
            reduction.write(rows if reduction.by_period else materialize(rows, reduction.name), prefix)


def nights_of(listing_days: DataFrame, grain: str = "week", week_start: str = "MON") -> DataFrame:
    """(apartment_id, period, nights): distinct booked nights from the month masks.

    The days of a week lie in one month or two; no day is in two masks, so the parts add up.
    """
    parts = night_parts(listing_days, grain, week_start)
    return parts if grain == "month" else parts.groupBy("apartment_id", "period").agg(F.sum("nights").alias("nights"))


def night_parts(listing_days: DataFrame, grain: str = "week", week_start: str = "MON") -> DataFrame:
    """As ``nights_of``, but a week in two months is two rows: for sums over listings, without a shuffle."""
    masks = listing_days.where(F.col("mask") != 0).select("apartment_id", F.col("day").alias("month"), "mask")
    if grain == "month":
        return masks.select("apartment_id", F.col("month").alias("period"), F.bit_count("mask").cast("long").alias("nights"))
    return masks.select("apartment_id", F.inline(_weeks_of_mask(F.col("month"), F.col("mask"), week_start))).where("nights > 0")


def _weeks_of_mask(month: Column, mask: Column, week_start: str) -> Column:
    """(period, nights) of the weeks that touch the month."""
    end = F.add_months(month, 1)
    weeks = F.sequence(period_start(month, "week", week_start), period_start(F.date_sub(end, 1), "week", week_start), F.expr("interval 7 days"))

    def part(week: Column) -> Column:
        low = F.greatest(F.datediff(week, month), F.lit(0))
        high = F.least(F.datediff(F.date_add(week, 7), month), F.datediff(end, month))
        ones = F.call_function("shiftleft", F.lit(1).cast("long"), high - low) - F.lit(1).cast("long")
        shifted = F.call_function("shiftright", mask, low)
        return F.struct(week.alias("period"), F.bit_count(shifted.bitwiseAND(ones)).cast("long").alias("nights"))

    return F.transform(weeks, part)


def listing_weeks_of(listing_days: DataFrame, week_start: str = "MON") -> DataFrame:
    """Revenue, bookings, stay and nights per (week, listing) with a confirmed booking: one shuffle."""
    week = period_start(F.col("day"), "week", week_start)
    none = F.lit(None)
    own = F.array(F.struct(
        week.alias("week_start_date"), "revenue", "confirmed", "stay_nights", "stays", F.lit(0).cast("long").alias("nights")))
    kinds = "struct<week_start_date:date,revenue:decimal(28,2),confirmed:bigint,stay_nights:bigint,stays:bigint,nights:bigint>"
    booked = F.transform(
        _weeks_of_mask(F.col("day"), F.col("mask"), week_start),
        lambda x: F.struct(x["period"], none, none, none, none, x["nights"]).cast(kinds))
    entries = F.when(F.coalesce(F.col("mask"), F.lit(0)) != 0, F.concat(own, booked)).otherwise(own)
    return (  # days without a confirmed booking or night hold none of the figures
        listing_days.where((F.col("confirmed") > 0) | (F.col("mask") != 0))
        .select("apartment_id", F.inline(entries))
        .groupBy("week_start_date", "apartment_id")
        .agg(
            F.sum("revenue").cast("double").alias("total_revenue"), F.coalesce(F.sum("confirmed"), F.lit(0)).alias("total_bookings"),
            F.try_divide(F.sum("stay_nights").cast("double"), F.sum("stays")).alias("avg_stay_duration"),
            (F.sum("nights") * 100.0 / F.lit(7.0)).cast("double").alias("occupancy_rate"),
        )
        .where(F.col("total_bookings") > 0)
    )


def user_days_of(user_days: DataFrame) -> DataFrame:
    """The stored rows without the listings: one row per (user, day)."""
    sums = ("bookings", "spend", "nights", "stays", "confirmed_nights", "confirmed_stays")
    return user_days.groupBy("user_id", "day").agg(
        F.min("first_booking").alias("first_booking"), F.max("last_booking").alias("last_booking"), *[F.sum(c).alias(c) for c in sums]
    )


def users_between(user_weeks: DataFrame, grain: str) -> DataFrame:
    """(period, users): the estimated number of users of the weeks that start in each month, quarter or year.

    Sketches are merged, users are not counted again; the relative standard error is
    1.04 / sqrt(2^SKETCH_BITS).
    """
    period = F.to_date(F.date_trunc(grain, "day")).alias("period")
    return user_weeks.groupBy(period).agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users"))
