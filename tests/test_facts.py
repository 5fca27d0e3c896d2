"""Stored reductions: same datasets as from the activity itself, merged parts, partial refresh."""

from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hostelry.operators import facts
from hostelry.operators.curated import with_activity_ids
from hostelry.plans import engagement, jobs, rental
from hostelry.queries import Data
from hostelry.schemas import create_layers, qualified
from hostelry.sources.tables import refresh_table

SMALL = "/root/testdata/sf0.001"
NOW = datetime(2001, 12, 31)


def _rows(df):
    def plain(v):
        return round(v, 9) if isinstance(v, float) else bytes(v) if isinstance(v, bytearray) else v

    columns = sorted(c for c in df.columns if c != "etl_inserted_at")
    return sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)


def _layers(spark, tmp_path, prefix, activity):
    data = Data(spark, SMALL)
    create_layers(spark, prefix, str(tmp_path / prefix))
    refresh_table(data.apartments, "curated_apartments", NOW, prefix)
    refresh_table(data.details, "curated_apartment_details", NOW, prefix)
    refresh_table(with_activity_ids(activity), "curated_user_activity", NOW, prefix)
    jobs.require_ok("presentation", jobs.build_presentation(spark, NOW, prefix))


ODD = "user_id long, apartment_id long, activity_type string, activity_date timestamp, checkin_date timestamp, checkout_date timestamp, stay_duration int, total_price double, booking_status string"


@pytest.fixture
def odd(spark):
    """Null dates, users and listings, stays over years and months' ends, repeated rows, no nights."""
    d = datetime
    rows = [
        (1, 1, "booking", d(2024, 1, 31, 23), d(2024, 1, 31), d(2024, 2, 1), 1, 10.5, "confirmed"),
        (1, 1, "booking", d(2024, 1, 31, 23), d(2024, 1, 31), d(2024, 2, 1), 1, 10.5, "confirmed"),
        (1, 1, "booking", d(2024, 2, 20), d(2023, 12, 30), d(2024, 3, 2), 63, 99.0, "confirmed"),
        (2, 1, "booking", None, d(2024, 2, 10), d(2024, 2, 12), 2, 5.0, "confirmed"),
        (2, None, "booking", d(2024, 2, 11), None, d(2024, 2, 12), 2, None, "confirmed"),
        (None, 2, "viewing", d(2024, 2, 11), None, None, None, None, None),
        (3, 2, "viewing", d(2024, 2, 12), None, None, None, None, None),
        (3, 2, "booking", d(2024, 2, 13), d(2024, 2, 15), d(2024, 2, 15), 0, 7.0, "confirmed"),
        (3, 2, "booking", d(2024, 2, 14), d(2024, 2, 16), d(2024, 2, 20), 4, 7.0, None),
        (3, 3, "booking", d(2024, 4, 1), d(2024, 3, 30), d(2024, 4, 2), 3, float("nan"), "confirmed"),
    ]
    return spark.createDataFrame(rows, ODD)


@pytest.mark.parametrize("source", ["odd", "sample"])
def test_nights_weeks_and_users_equal_the_direct_way(spark, odd, source):
    activity = odd if source == "odd" else Data(spark, SMALL).activity
    listing_days, user_days = facts.LISTING_DAYS.of(activity), facts.USER_DAYS.of(activity)
    for grain in ("week", "month"):
        direct = rental.nights_per_period(rental.confirmed_of(activity), grain)
        assert _rows(facts.nights_of(listing_days, grain)) == _rows(direct)
    assert _rows(facts.nights_of(listing_days, "week", "SUN")) == _rows(
        rental.nights_per_period(rental.confirmed_of(activity), "week", "SUN"))
    assert _rows(facts.listing_weeks_of(listing_days)) == _rows(rental.listing_weeks(activity))
    assert _rows(engagement.engagement_of(facts.user_days_of(user_days))) == _rows(engagement.user_engagement(activity))


@pytest.mark.parametrize("reduction", [facts.LISTING_DAYS, facts.USER_DAYS], ids=lambda r: r.name)
def test_merged_parts_equal_the_whole(spark, odd, reduction):
    whole = _rows(reduction.of(odd))
    marked = odd.withColumn("part", F.pmod(F.hash(*odd.columns), F.lit(3)))
    parts = [reduction.of(marked.where(F.col("part") == i)) for i in range(3)]
    assert _rows(reduction.merged(parts[0].unionByName(parts[1]).unionByName(parts[2]))) == whole


def test_sketches_merge(spark):
    rows = spark.range(40_000).selectExpr(
        "id % 9000 AS user_id", "id AS apartment_id", "'viewing' AS activity_type",
        "timestamp'2024-01-01' + make_interval(0, 0, 0, cast(id % 120 AS int)) AS activity_date", "cast(null AS timestamp) AS checkin_date",
        "cast(null AS timestamp) AS checkout_date", "cast(null AS int) AS stay_duration", "cast(null AS double) AS total_price",
        "cast(null AS string) AS booking_status")
    weeks = facts.USER_WEEKS.of(facts.USER_DAYS.of(rows))
    bound = 3 * 1.04 / 2 ** (facts.SKETCH_BITS / 2)
    exact = {r[0]: r[1] for r in rows.groupBy(F.to_date(F.date_trunc("quarter", F.date_trunc("week", "activity_date")))).agg(F.countDistinct("user_id")).collect()}
    told = {r["period"]: r["users"] for r in facts.users_between(weeks, "quarter").collect()}
    assert told.keys() == exact.keys()
    assert all(abs(told[k] - exact[k]) <= bound * exact[k] for k in exact)
    halves = weeks.unionByName(facts.USER_WEEKS.of(facts.USER_DAYS.of(rows.where("user_id % 2 = 0"))))
    again = {r["period"]: r["users"] for r in facts.users_between(facts.USER_WEEKS.merged(halves), "quarter").collect()}
    assert again.keys() == exact.keys() and all(abs(again[k] - exact[k]) <= bound * exact[k] for k in exact)


def test_datasets_read_the_reductions_only(spark, tmp_path):
    """Two reads of the activity table give all six datasets."""
    prefix = "ft_"
    _layers(spark, tmp_path, prefix, Data(spark, SMALL).activity)
    activity = spark.table(qualified("curated_user_activity", prefix))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for reduction in (facts.LISTING_DAYS, facts.USER_DAYS):
        assert plan(reduction.of(activity)).count("FileScan") == 1
    direct = {
        "pres_rental_performance_weekly": lambda d: rental.rental_performance(*d.places, "week"),
        "pres_rental_performance_monthly": lambda d: rental.rental_performance(*d.places, "month"),
        "pres_popular_locations_weekly": lambda d: rental.popular_locations(*d.places),
        "pres_top_listings_weekly": lambda d: rental.top_listings(*d.places),
        "pres_user_engagement_weekly": lambda d: d.engagement(),
        "pres_user_booking_history": lambda d: d.history(),
    }
    for name, build in jobs._datasets(spark, prefix).items():
        assert "curated_user_activity" not in plan(build())
        assert _rows(spark.table(qualified(name, prefix))) == _rows(direct[name](Data(spark, SMALL)))


def _files(tmp_path, prefix):
    return {str(p) for p in Path(tmp_path / prefix).rglob("*.parquet")}


def test_late_bookings_rewrite_their_periods_only(spark, tmp_path):
    activity = Data(spark, SMALL).activity
    late = "activity_date >= '1997-03-05' AND activity_date < '1997-03-20' AND source_id % 2 = 1"
    _layers(spark, tmp_path, "fw_", activity)
    _layers(spark, tmp_path, "fp_", activity.where(f"NOT ({late})"))
    before = _files(tmp_path, "fp_")
    rows = activity.where(late)
    assert rows.count() > 2
    jobs.require_ok("refresh", jobs.refresh_presentation(spark, rows, NOW, "fp_"))
    for name in jobs._datasets(spark, "fw_"):
        assert _rows(spark.table(qualified(name, "fp_"))) == _rows(spark.table(qualified(name, "fw_"))), name
    for reduction in facts.REDUCTIONS[:2]:
        assert _rows(reduction.read(spark, "fp_")) == _rows(reduction.read(spark, "fw_"))
    kept = before & _files(tmp_path, "fp_")
    weeks = jobs.touched_weeks(rows)
    assert min(weeks) >= date(1997, 3, 3) and max(weeks) <= date(1997, 5, 26)
    for table, folder, touched in (
        ("pres_user_booking_history", "week_start_date=", {str(w) for w in weeks}),
        ("fact_listing_days", "period=", {"1997-01-01", "1997-04-01"}), ("fact_user_days", "period=", {"1997-01-01"}),
    ):
        old = {p for p in before if f"/{table}/" in p}
        assert len(old & kept) > len(old) / 2, table
        assert {p.split(folder)[1][:10] for p in old - kept} <= touched, table
    ids = spark.table("fp_curated.curated_user_activity").agg(F.countDistinct("activity_id"), F.max("activity_id"), F.count("*")).first()
    assert ids[0] == ids[1] == ids[2] == activity.count()
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static").lower() == "static"


def test_late_activity_is_computed_once(spark, tmp_path):
    activity = Data(spark, SMALL).activity
    late = (F.col("activity_date") >= "1997-03-05") & (F.col("activity_date") < "1997-03-20") & (F.col("source_id") % 2 == 1)
    _layers(spark, tmp_path, "fo_", activity.where(~late))
    rows, computed = activity.where(late), spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            computed.add(len(batch))
            yield batch

    jobs.require_ok("refresh", jobs.refresh_presentation(spark, rows.mapInPandas(count, rows.schema), NOW, "fo_"))
    assert computed.value == rows.count() > 2
    # Whole scans of the user days take two columns, for the first days; the others are pruned to folders.
    plan = jobs._datasets(spark, "fo_", jobs.touched_weeks(rows))[jobs.RUNNING]()._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan" in x and "fact_user_days" in x]
    whole = [x for x in scans if "spend" not in x.split("ReadSchema")[-1] and "bookings" not in x.split("ReadSchema")[-1]]
    assert len(scans) == 2 and len(whole) == 1


def test_late_first_days_and_other_activity_reach_the_users(spark, tmp_path):
    """A user known since June turns out to have been there in March, by activity of a kind of its own."""
    activity = Data(spark, SMALL).activity
    first = activity.groupBy("user_id").agg(F.min("activity_date").alias("first")).where("first > '1996-01-01'").orderBy("user_id").limit(1)
    like = activity.where("activity_type = 'viewing'").limit(1).drop("user_id")
    late = like.crossJoin(first.select("user_id")).withColumns({
        "activity_date": F.lit("1995-11-08 10:00:00").cast("timestamp"), "activity_type": F.lit("call"), "source_id": F.lit(10**9)})
    late = spark.createDataFrame(late.select(*activity.columns).collect(), activity.schema)
    _layers(spark, tmp_path, "fr_", activity)
    before = {r["week_start_date"]: r for r in spark.table(qualified(jobs.RUNNING, "fr_")).collect()}
    jobs.require_ok("refresh", jobs.refresh_presentation(spark, late, NOW, "fr_"))
    stored = spark.table(qualified(jobs.RUNNING, "fr_"))
    assert _rows(stored) == _rows(engagement.user_engagement(activity.unionByName(late)))
    after = {r["week_start_date"]: r for r in stored.collect()}
    changed = {w for w in after if w not in before or after[w].new_users != before[w].new_users}
    assert len(changed) == 2 and date(1995, 11, 6) in changed


def test_ids_need_no_second_shuffle_of_the_activity(spark):
    key, activity = "spark.sql.autoBroadcastJoinThreshold", Data(spark, SMALL).activity
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        numbered = with_activity_ids(activity)
        plan = numbered._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 1
        ids = [r[0] for r in numbered.orderBy("activity_date", "activity_type", F.col("etl_inserted_at")).select("activity_id").collect()]
        assert sorted(ids) == list(range(1, activity.count() + 1))
    finally:
        spark.conf.set(key, before)
