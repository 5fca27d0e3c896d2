from datetime import datetime

import pytest
from conftest import collect

from hostelry.operators import enrich

NOW = datetime(2024, 1, 10, 12)


def at(day, hour=0, minute=0, second=0):
    return datetime(2024, 1, day, hour, minute, second)


def test_days_since_listing_null_past_and_future(rows):
    df = rows("id long, price double, listing_created_on timestamp",
              (1, 5.0, None), (2, 6.0, at(1, 23, 59, 59)), (3, 7.0, at(20)))
    out = enrich.enrich_apartments(df, NOW)
    assert collect(out.select("id", "days_since_listing", "price_usd"), "id") == [
        (1, 0, 5.0), (2, 9, 6.0), (3, -10, 7.0)
    ]
    assert {r.processed_at for r in out.collect()} == {NOW}


def test_viewing_duration_absent_end_is_zero(rows):
    df = rows("id long, viewed_at timestamp", (1, at(1)), (2, None))
    out = enrich.enrich_viewings(df, NOW)
    assert [r[0] for r in out.select("viewing_duration_seconds").collect()] == [0, 0]


def test_viewing_duration_day_resolution_and_exact(rows):
    df = rows("id long, viewed_at timestamp, viewing_end_time timestamp",
              (1, at(1, 23, 59, 59), at(2, 0, 0, 1)), (2, at(1), None), (3, None, at(1)),
              (4, at(3, 8), at(3, 20)))
    by_day = enrich.enrich_viewings(df, NOW).select("id", "viewing_duration_seconds")
    exact = enrich.enrich_viewings(df, NOW, exact=True).select("id", "viewing_duration_seconds")
    assert collect(by_day, "id") == [(1, 86400), (2, 0), (3, 0), (4, 0)]
    assert collect(exact, "id") == [(1, 2), (2, 0), (3, 0), (4, 43200)]


def test_booking_duration(rows):
    df = rows("id long, checkin_date timestamp, checkout_date timestamp",
              (1, at(1), at(4)), (2, at(4), at(4)), (3, at(4), at(2)), (4, None, at(2)))
    out = enrich.enrich_bookings(df, NOW).select("id", "booking_duration_days")
    assert collect(out, "id") == [(1, 3), (2, 0), (3, -2), (4, 0)]


def test_booking_duration_needs_both_columns(rows):
    out = enrich.enrich_bookings(rows("id long, checkin_date timestamp", (1, at(1))), NOW)
    assert "booking_duration_days" not in out.columns


@pytest.mark.parametrize("schema, expected", [
    ("id long, square_feet int, price double", [0.5, 0.0, 0.0, 0.0, 0.0]),
    ("id long, square_feet int, rent double", [0.0] * 5),
])
def test_price_per_sqft(rows, schema, expected):
    df = rows(schema, (1, 100, 50.0), (2, None, 50.0), (3, 0, 50.0), (4, -5, 50.0), (5, 10, None))
    out = enrich.enrich_attributes(df, NOW).select("id", "price_per_sqft")
    assert [v for _, v in collect(out, "id")] == expected
    assert dict(out.dtypes)["price_per_sqft"] == "double"


def test_price_display_goes_first(rows):
    df = rows("square_feet int, price double, price_display double", (10, 1.0, 20.0), (10, 5.0, None))
    out = enrich.enrich_attributes(df, NOW).select("price_per_sqft")
    assert sorted(r[0] for r in out.collect()) == [0.0, 2.0]


def test_constant_currency(rows):
    df = rows("id long, currency string", (1, "EUR"), (2, None))
    assert {r.currency for r in enrich.with_constant_currency(df).collect()} == {"USD"}
