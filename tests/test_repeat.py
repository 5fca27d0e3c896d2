import random
from datetime import datetime, timedelta

import pytest
from conftest import collect
from pyspark.sql import functions as F

from hostelry.operators.repeat import flag_repeat_days, rolling_counts, rolling_repeat

T0 = datetime(2024, 1, 1)
SCHEMA = "id long, user_id long, booking_date timestamp"


def test_window_edge_is_included(rows):
    df = rows(SCHEMA, (1, 1, T0), (2, 1, T0 + timedelta(days=30)),
              (3, 2, T0), (4, 2, T0 + timedelta(days=30, seconds=1)),
              (5, 3, T0), (6, 3, T0), (7, None, T0), (8, 4, None))
    out = rolling_repeat(df).select("id", "bookings_in_window", "is_repeat")
    assert collect(out, "id") == [
        (1, 1, False), (2, 2, True), (3, 1, False), (4, 1, False),
        (5, 2, True), (6, 2, True), (7, 0, False), (8, 0, False),
    ]


def bookings(seed, n, step):
    """A third of the rows belong to one user."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        user = 0 if rng.random() < 1 / 3 else rng.randrange(1, 40)
        out.append((i, user, T0 + step * rng.randrange(0, 4000)))
    return out


@pytest.mark.parametrize("step", [
    timedelta(hours=3), timedelta(days=1), timedelta(seconds=41, microseconds=7),
])
def test_rolling_counts_match_brute_force(rows, step):
    data = bookings(5, 600, step)
    window = timedelta(days=30)
    expected = {
        (u, t): sum(1 for _, v, s in data if v == u and t - window <= s <= t) for _, u, t in data
    }
    out = rolling_counts(rows(SCHEMA, *data))
    assert {(r.user_id, r.booking_date): r.bookings_in_window for r in out.collect()} == expected


@pytest.mark.parametrize("step", [timedelta(hours=7), timedelta(days=4)])
def test_day_flags_agree_with_booking_flags(rows, step):
    df = rows(SCHEMA, *bookings(9, 500, step))
    per_booking = (
        rolling_repeat(df).groupBy("user_id", F.to_date("booking_date").alias("day"))
        .agg(F.bool_or("is_repeat").alias("is_repeat"))
    )
    days = df.groupBy("user_id", F.to_date("booking_date").alias("day")).agg(
        F.count(F.lit(1)).alias("bookings"), F.min("booking_date").alias("first_booking"),
        F.max("booking_date").alias("last_booking"),
    )
    flags = flag_repeat_days(days).select("user_id", "day", "is_repeat")
    assert collect(flags, "user_id", "day") == collect(per_booking, "user_id", "day")
