import random
from datetime import date, datetime, timedelta

import pytest
from conftest import collect
from pyspark.sql import functions as F

from hostelry.functions.columns import period_end, period_start
from hostelry.operators import periods

STAYS = "apartment_id long, checkin_date timestamp, checkout_date timestamp"


def day(n):
    return datetime(2024, 1, 1) + timedelta(days=n)


def test_week_and_month_starts(rows):
    df = rows("t timestamp", (datetime(2024, 3, 3, 23, 59),), (datetime(2024, 3, 4),))
    out = df.select(
        period_start(F.col("t")), period_start(F.col("t"), "week", "SUN"),
        period_start(F.col("t"), "month"),
    )
    assert collect(out, "t") == [
        (date(2024, 2, 26), date(2024, 3, 3), date(2024, 3, 1)),
        (date(2024, 3, 4), date(2024, 3, 3), date(2024, 3, 1)),
    ]
    with pytest.raises(ValueError):
        period_start(F.col("t"), "year")


def test_period_end(rows):
    df = rows("d date", (date(2024, 2, 1),))
    assert tuple(df.select(period_end(F.col("d")), period_end(F.col("d"), "month")).first()) == (
        date(2024, 2, 8), date(2024, 3, 1)
    )


def test_lookback_is_half_open(rows):
    now = datetime(2024, 1, 10, 12)
    df = rows("t timestamp", (datetime(2024, 1, 3, 11, 59, 59),), (datetime(2024, 1, 3, 12),),
              (datetime(2024, 1, 11, 11, 59, 59),), (datetime(2024, 1, 11, 12),), (None,))
    out = collect(periods.lookback(df, "t", now, 7), "t")
    assert out == [(datetime(2024, 1, 3, 12),), (datetime(2024, 1, 11, 11, 59, 59),)]


def test_spine_covers_both_ends_and_survives_reversed_bounds(rows):
    schema = "first date, last date"
    spine = periods.period_spine(rows(schema, (date(2024, 1, 1), date(2024, 1, 15))))
    assert [r[0] for r in collect(spine, "period")] == [
        date(2024, 1, 1), date(2024, 1, 8), date(2024, 1, 15)
    ]
    months = periods.period_spine(rows(schema, (date(2023, 12, 1), date(2024, 2, 1))), "month")
    assert months.count() == 3
    assert periods.period_spine(rows(schema, (date(2024, 1, 8), date(2024, 1, 1)))).count() == 1
    assert periods.period_spine(rows(schema, (None, None))).count() == 0


def test_nights_overlap_and_empty_stays(rows):
    df = rows(STAYS, (1, day(0), day(3)), (1, day(1), day(4)), (1, day(5), day(5)),
              (1, day(9), day(7)), (2, None, day(3)), (2, day(2), None))
    assert collect(periods.booked_nights(df), "apartment_id", "night") == [
        (1, date(2024, 1, 1) + timedelta(days=i)) for i in range(4)
    ]


@pytest.mark.parametrize("grain, week_start", [("week", "MON"), ("week", "SUN"), ("month", "MON")])
def test_masks_count_the_same_nights_as_expansion(rows, grain, week_start):
    rng = random.Random(3)
    stays = []
    for _ in range(300):
        start = rng.randrange(0, 400)
        stays.append((rng.randrange(6) if rng.random() < 0.6 else 7, day(start),
                      day(start + rng.randrange(-2, 70))))
    df = rows(STAYS, *stays)
    expected = (
        periods.booked_nights(df)
        .groupBy("apartment_id", period_start(F.col("night"), grain, week_start).alias("period"))
        .agg(F.count(F.lit(1)).alias("nights"))
    )
    actual = periods.nights_per_period(df, grain, week_start)
    order = ("apartment_id", "period")
    assert collect(actual, *order) == collect(expected, *order)
