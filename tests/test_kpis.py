from datetime import date, datetime

import pytest

from hostelry.operators import enrich
from hostelry.plans import kpis

NOW = datetime(2024, 1, 10)
APARTMENTS = "id long, price double, listing_created_on timestamp, is_active boolean"
VIEWINGS = "id long, user_id long, viewed_at timestamp, is_wishlisted boolean"
BOOKINGS = (
    "id long, total_price double, booking_status string, checkin_date timestamp, "
    "checkout_date timestamp"
)


def metrics(rows, apartments=(), viewings=(), bookings=(), **kw):
    return kpis.presentation_metrics(
        enrich.enrich_apartments(rows(APARTMENTS, *apartments), NOW),
        enrich.enrich_viewings(rows(VIEWINGS, *viewings), NOW),
        enrich.enrich_bookings(rows(BOOKINGS, *bookings), NOW), NOW, **kw,
    )


def test_counts_rates_and_zero_entering_averages(rows):
    row = metrics(
        rows,
        [(1, 10.0, datetime(2024, 1, 8), True), (2, 20.1, None, False), (None, None, None, None)],
        [(1, 7, NOW, True), (2, 7, NOW, None), (3, None, NOW, False), (4, 8, NOW, False)],
        [(1, 0.1, "confirmed", datetime(2024, 1, 1), datetime(2024, 1, 4)), (2, 0.2, "pending", None, None),
         (3, None, None, None, None)],
        distinct_users=True,
    ).first()
    assert (row.total_listings, row.active_listings) == (2, 1)
    assert (row.avg_price, row.min_price, row.max_price) == (15.05, 10.0, 20.1)
    assert row.avg_days_listed == pytest.approx(2 / 3)
    assert (row.total_viewings, row.total_wishlisted, row.total_users) == (4, 1, 3)
    assert (row.distinct_users, row.total_timed_viewings, row.avg_viewing_duration) == (2, 4, 0.0)
    assert (row.total_bookings, row.confirmed_bookings) == (3, 1)
    assert row.total_booking_value == 0.3  # exact, unlike 0.1 + 0.2
    assert row.avg_booking_duration == 1.0
    assert (row.booking_conversion_rate, row.wishlist_rate) == (0.75, 0.25)
    assert row.avg_viewings_per_listing == 4.0
    assert (row.metrics_date, row.generated_at) == (date(2024, 1, 10), NOW)


def test_empty_tables(rows):
    row = metrics(rows).first()
    assert (row.total_listings, row.total_viewings, row.total_bookings) == (0, 0, 0)
    assert row.avg_price is None and row.total_booking_value is None
    assert row.booking_conversion_rate == row.wishlist_rate == row.avg_viewings_per_listing == 0.0


def test_nan_price_is_missing(rows):
    row = metrics(rows, [(1, float("nan"), None, True), (2, 4.0, None, True)]).first()
    assert row.avg_price == 4.0
