"""Rental and engagement datasets on hand-written activity."""

from datetime import date, datetime, timedelta

import pytest
from conftest import collect
from pyspark.sql import functions as F

from hostelry.operators.curated import user_activity, with_activity_ids
from hostelry.operators.enrich import enrich_bookings, enrich_viewings
from hostelry.plans import engagement, insights, rental

NOW = datetime(2024, 3, 1)
MON = date(2024, 1, 1)  # a Monday


def t(days, seconds=0):
    return datetime(2024, 1, 1) + timedelta(days=days, seconds=seconds)


@pytest.fixture
def world(rows):
    apartments = rows(
        "apartment_id long, title string, price double, is_active boolean, listing_created_on timestamp",
        (1, "one", 100.0, True, t(0)), (2, "two", 200.0, True, t(7)),
        (3, "three", 999.0, False, t(0)), (4, "four", 50.0, True, None), (5, "five", 300.0, True, t(8)),
    )
    details = rows(
        "apartment_id long, city string, state string, price_per_sqft double",
        (1, "Rome", "IT", 2.0), (2, "Rome", "IT", 0.0), (3, "Oslo", "NO", 5.0), (5, "Bonn", None, 4.0),
    )
    viewings = rows(
        "id long, user_id long, apartment_id long, viewed_at timestamp, is_wishlisted boolean",
        (1, 10, 1, t(0), True), (2, 11, 1, t(1), False), (3, 12, 99, t(8), None), (4, 10, 2, t(9), False),
    )
    bookings = rows(
        "id long, booking_id long, user_id long, apartment_id long, booking_date timestamp, "
        "checkin_date timestamp, checkout_date timestamp, total_price double, booking_status string",
        (1, 1, 10, 1, t(0), t(5), t(9), 400.0, "confirmed"),   # nights 5..8
        (2, 2, 11, 1, t(1), t(8), t(10), 100.0, "confirmed"),  # overlaps night 8
        (3, 3, 10, 2, t(8), t(9), t(9), 50.0, "confirmed"),    # no night
        (4, 4, 10, 1, t(9), None, t(12), 70.0, "pending"),
        (5, 5, 13, 2, t(10), t(11), t(12), 500.0, "confirmed"),
        (6, 6, 14, 3, t(10), t(10), t(12), 500.0, "confirmed"),
    )
    activity = user_activity(enrich_viewings(viewings, NOW), enrich_bookings(bookings, NOW), NOW)
    return apartments, details, activity


def test_union_keeps_every_row_and_pads(world):
    activity = world[2]
    counts = {r.activity_type: r["count"] for r in activity.groupBy("activity_type").count().collect()}
    assert counts == {"viewing": 4, "booking": 6}
    viewing = activity.where("activity_type = 'viewing'").first()
    assert viewing.booking_id is None and viewing.stay_duration is None


def test_ids_are_dense_and_follow_time(world, spark):
    out = with_activity_ids(world[2].withColumn(
        "activity_date", F.when(F.col("source_id") != 3, F.col("activity_date"))))
    got = collect(out.select("activity_id", "activity_date", "activity_type"), "activity_id")
    assert [g[0] for g in got] == list(range(1, 11))
    assert got[0][1] is None and got[1][1] is None  # missing times first
    times = [g[1:] for g in got[2:]]
    assert times == sorted(times)


def test_ids_across_many_files(spark):
    n = 5000
    activity = spark.range(n).selectExpr(
        "id AS source_id", "id % 7 AS user_id", "1L AS apartment_id", "'viewing' AS activity_type",
        "timestamp'2024-01-01' + make_dt_interval(0, 0, 0, id % 13) AS activity_date",
        "timestamp'2024-01-01' AS etl_inserted_at",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rest = {c: F.lit(None) for c in (
            "is_wishlisted", "call_to_action", "booking_id", "checkin_date", "checkout_date",
            "stay_duration", "total_price", "booking_status", "payment_status", "num_guests")}
        typed = activity.withColumns({k: v.cast("string") for k, v in rest.items()})
        out = with_activity_ids(typed)
        stats = out.agg(F.min("activity_id"), F.max("activity_id"), F.countDistinct("activity_id")).first()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tuple(stats) == (1, n, n)


def test_weekly_performance(world):
    out = collect(rental.rental_performance(*world), "week_start_date")
    # week 0: listing 1 only; nights 5, 6 of 7.  week 1: listings 1, 2, 5.
    assert out[0] == (MON, 100.0, 100.0, 1, 2, pytest.approx(200 / 7), 2.0)
    week1 = out[1]
    assert week1[:5] == (MON + timedelta(days=7), 200.0, 200.0, 3, 2)
    # nights 7, 8, 9 of listing 1 and night 11 of listing 2; the inactive listing counts for nothing
    assert week1[5] == pytest.approx(100 * 4 / 21)
    assert week1[6] == 3.0
    assert len(out) == 2


def test_monthly_performance_and_other_week_start(world):
    month = rental.rental_performance(*world, grain="month").collect()
    assert len(month) == 1
    row = month[0]
    assert (row.month_start_date, row.total_active_listings, row.new_listings) == (MON, 3, 4)
    assert row.occupancy_rate == pytest.approx(100 * 6 / (31 * 3))
    sunday = rental.rental_performance(*world, week_start="SUN").orderBy("week_start_date").first()
    assert sunday.week_start_date == date(2023, 12, 31)


def test_performance_without_activity_or_listings(world):
    apartments, details, activity = world
    quiet = rental.rental_performance(apartments, details, activity.limit(0)).collect()
    assert {r.occupancy_rate for r in quiet} == {0.0} and len(quiet) == 2
    assert rental.rental_performance(apartments.limit(0), details, activity).count() == 0


def test_popular_locations(world):
    out = {(r.week_start_date, r.city, r.state): r for r in rental.popular_locations(*world).collect()}
    rome = out[(MON, "Rome", "IT")]
    assert (rome.total_bookings, rome.total_viewings, rome.avg_price) == (2, 2, 100.0)
    assert rome.booking_conversion_rate == 100.0
    later = out[(MON + timedelta(days=7), "Rome", "IT")]
    assert (later.total_bookings, later.total_viewings) == (3, 1)
    assert later.avg_price == pytest.approx((200 + 100 + 200) / 3)
    oslo = out[(MON + timedelta(days=7), "Oslo", "NO")]
    assert (oslo.total_viewings, oslo.booking_conversion_rate) == (0, 0.0)
    unknown = out[(MON + timedelta(days=7), None, None)]  # a viewing of an unknown listing is kept
    assert (unknown.total_bookings, unknown.total_viewings, unknown.avg_price) == (0, 1, None)


def test_top_listings_with_ties(world):
    out = collect(rental.top_listings(*world, n=2), "week_start_date", "apartment_id")
    assert out[0] == (MON, 1, "one", "Rome", "IT", 500.0, 2, 3.0, pytest.approx(200 / 7))
    second = [r[1] for r in out if r[0] == MON + timedelta(days=7)]
    assert second == [2, 3]  # 550 before 500
    one = collect(rental.top_listings(*world, n=1), "week_start_date")
    assert [r[1] for r in one] == [1, 2]


def test_since_gives_the_same_weeks(world, rows):
    apartments, details, activity = world
    since = F.lit(MON + timedelta(days=7))
    later = F.col("week_start_date") >= since
    for full, cut, order in [
        (rental.popular_locations(*world), rental.popular_locations(*world, since=since),
         ("week_start_date", "city")),
        (rental.top_listings(*world), rental.top_listings(*world, since=since),
         ("week_start_date", "apartment_id")),
        (engagement.user_booking_history(activity, details),
         engagement.user_booking_history(activity, details, since=since),
         ("week_start_date", "user_id")),
    ]:
        assert collect(full.where(later), *order) == collect(cut, *order)


def test_user_engagement(world):
    out = collect(engagement.user_engagement(world[2]), "week_start_date")
    assert out[0] == (MON, 2, 2, 2, 2, 1.0, 3.0, 0.0)
    # users 10, 12, 13, 14; bookers 10 (twice), 13, 14; user 10 repeats
    week1 = out[1]
    assert week1[:6] == (MON + timedelta(days=7), 5, 4, 3, 4, pytest.approx(4 / 3))
    assert week1[6] == pytest.approx((0 + 1 + 2) / 3)
    assert week1[7] == pytest.approx(100 / 3)


def test_engagement_invariants(world):
    out = engagement.user_engagement(world[2]).orderBy("week_start_date").collect()
    assert sum(r.new_users for r in out) == out[-1].total_users
    assert all(r.active_users >= r.new_users for r in out)


def test_booking_history_and_favorite_tie(world, rows):
    apartments, details, activity = world
    out = {(r.user_id, r.week_start_date): r
           for r in engagement.user_booking_history(activity, details).collect()}
    ten = out[(10, MON + timedelta(days=7))]
    assert (ten.total_bookings, ten.total_spend, ten.avg_booking_duration) == (2, 120.0, 0.0)
    assert ten.is_repeat_customer and ten.favorite_city == "Rome"
    assert out[(14, MON + timedelta(days=7))].favorite_city == "Oslo"
    tied = details.withColumn("city", F.when(F.col("apartment_id") == 1, F.lit("Aalen")).otherwise(F.col("city")))
    history = engagement.user_booking_history(activity, tied)
    row = history.where((F.col("user_id") == 10) & (F.col("week_start_date") > F.lit(MON))).first()
    assert row.favorite_city == "Aalen"  # one booking each, first by name


def test_repeat_edge_thirty_days(rows):
    schema = "id long, user_id long, apartment_id long, booking_date timestamp, booking_status string, " \
             "total_price double, checkin_date timestamp, checkout_date timestamp"
    bookings = rows(schema,
                    (1, 1, 1, t(0), "confirmed", 1.0, None, None), (2, 1, 1, t(30), "confirmed", 1.0, None, None),
                    (3, 2, 1, t(0), "confirmed", 1.0, None, None), (4, 2, 1, t(30, 1), "confirmed", 1.0, None, None))
    viewings = rows("id long, user_id long, apartment_id long, viewed_at timestamp")
    activity = user_activity(enrich_viewings(viewings, NOW), enrich_bookings(bookings, NOW), NOW)
    details = rows("apartment_id long, city string", (1, "Rome"))
    history = engagement.user_booking_history(activity, details).where("week_start_date > '2024-01-20'")
    assert collect(history.select("user_id", "is_repeat_customer"), "user_id") == [(1, True), (2, False)]
    assert {r.avg_booking_duration for r in history.collect()} == {None}  # unknown stays are skipped


def test_summary_and_empty_base(rows):
    schema = "week_start_date date, v double"
    full = insights.series_summary(rows(schema, (date(2024, 1, 8), 30.0), (MON, 20.0), (date(2024, 1, 15), None)), "v")
    assert tuple(full.first()) == (25.0, 30.0, 20.0, 20.0, None, None, None)
    zero = insights.series_summary(rows(schema, (MON, 0.0), (date(2024, 1, 8), 5.0)), "v").first()
    assert zero.trend == 5.0 and zero.trend_pct is None


def test_city_trends_and_label(rows):
    places = rows("week_start_date date, city string, state string, total_bookings long, total_viewings long, "
                  "avg_price double, booking_conversion_rate double",
                  (MON, "A", "x", 1, 1, 1.0, 1.0), (MON, "B", "x", 5, 1, 1.0, 1.0),
                  (MON, "C", None, 5, 1, 1.0, 1.0), (date(2024, 1, 8), "B", "x", 2, 0, 1.0, 1.0))
    wide = insights.city_trends(places, 2)
    assert set(wide.columns) == {"week_start_date", "B", "C"}
    assert collect(wide.select("week_start_date", "B", "C"), "week_start_date") == [
        (MON, 5, 5), (date(2024, 1, 8), 2, None)]
    top = insights.top_cities_latest(places).collect()
    assert [(r.place, r.week) for r in top] == [("B, x", "2024-01-08")]
    older = insights.top_cities_latest(places.where("total_viewings > 0")).collect()
    assert [r.place for r in older] == ["B, x", None, "A, x"]


def test_correlations_without_variance_or_pairs(rows):
    schema = "total_bookings long, avg_booking_duration double, total_spend double"
    for data in ([(1, 2.0, 5.0), (1, 2.0, 6.0)], [(1, None, 5.0)], [(0, 1.0, 1.0), (0, 2.0, 9.0)], []):
        assert insights.duration_spend_correlation(rows(schema, *data)).first()[0] is None
    data = [(1, 1.0, 2.0), (2, 2.0, 4.0), (3, 3.0, 6.0), (1, None, 100.0), (0, 9.0, 0.0)]
    assert insights.duration_spend_correlation(rows(schema, *data)).first()[0] == pytest.approx(1.0)


def test_repeat_comparison_one_sided(rows):
    schema = "is_repeat_customer boolean, total_spend double, avg_booking_duration double"
    df = rows(schema, (True, 30.0, 2.0), (True, 10.0, 4.0), (None, 1.0, 1.0))
    row = insights.repeat_comparison(df).first()
    assert (row.repeat_customers, row.one_time_customers, row.repeat_avg_spend) == (2, 0, 20.0)
    assert row.one_time_avg_spend is None and row.spend_uplift_pct is None
    assert row.repeat_share_pct == pytest.approx(200 / 3)
    repeat, single = insights.customers_by_kind(df)
    assert (repeat.count(), single.count()) == (2, 0)


def test_latest_week_and_activity_rate(rows):
    df = rows("week_start_date date, active_users long, total_users long", (MON, 1, 4), (date(2024, 1, 8), 0, 0))
    assert insights.latest_week(df).count() == 1
    assert [r.activity_rate for r in insights.activity_rate(df).orderBy("week_start_date").collect()] == [25.0, 0.0]
    assert insights.average_activity_rate(df).first()[0] == 12.5


def test_weekly_active_users_exact_and_sketch(world):
    exact = collect(engagement.weekly_active_users(world[2]), "week_start_date")
    assert exact == [(MON, 2), (MON + timedelta(days=7), 4)]
    assert collect(engagement.weekly_active_users(world[2], approx=True), "week_start_date") == exact
