from datetime import date

import pytest
from conftest import collect
from pyspark.sql import functions as F

from hostelry.operators import ranking
from hostelry.plans import insights

W1, W2 = date(2024, 1, 1), date(2024, 1, 8)


def test_ties_at_the_last_rank(rows):
    df = rows("g int, k int, v double", (1, 3, 5.0), (1, 1, 5.0), (1, 2, 9.0), (2, 4, None), (2, 5, 0.0))
    order = [F.col("v").desc_nulls_last(), F.col("k")]
    assert collect(ranking.top_per_group(df, "g", order, 2), "g", "k") == [
        (1, 1, 5.0), (1, 2, 9.0), (2, 4, None), (2, 5, 0.0)
    ]


def test_latest_top_k_never_reaches_older_weeks(rows):
    df = rows("w date, k string, v int", (W1, "a", 100), (W2, "c", 1), (W2, "b", 1), (W1, "z", 50), (None, "n", 9))
    order = [F.col("v").desc(), F.col("k")]
    assert collect(ranking.latest_top_k(df, "w", order, 3), "k") == [(W2, "b", 1), (W2, "c", 1)]
    assert collect(ranking.latest_top_k(df, "w", order, 1)) == [(W2, "b", 1)]


def test_top_totals_and_semi_join(rows):
    df = rows("city string, n int", ("b", 3), ("a", 1), ("a", 2), ("c", 1))
    top = ranking.top_totals(df, "city", "n", 2)
    assert [r.city for r in top.collect()] == ["a", "b"]
    assert ranking.keep_keys(df, top, "city").count() == 3


def test_missing_city_takes_no_place_and_a_name_is_one_city(rows):
    places = rows("week_start_date date, city string, state string, total_bookings long",
                  (W1, None, None, 99), (W1, "A", "x", 3), (W1, "A", "y", 2), (W2, "B", "x", 4), (W2, "C", "x", 1))
    wide = insights.city_trends(places, 2)
    assert wide.columns == ["week_start_date", "A", "B"]
    assert collect(wide, "week_start_date") == [(W1, 5, None), (W2, None, 4)]
    ranked = insights.ranked_city_trends(places, 2)
    assert ranked.columns == ["week_start_date", "city_1", "bookings_1", "city_2", "bookings_2"]
    assert collect(ranked, "week_start_date") == [(W1, "A", 5, None, None), (W2, None, None, "B", 4)]


def test_pivot_fills_and_rejects_repeats(rows):
    schema = "w date, city string, n int"
    wide = ranking.pivot_unique(rows(schema, (W1, "a", 1), (W2, "b", 2)), "w", "city", "n", ["a", "b"])
    assert collect(wide, "w") == [(W1, 1, None), (W2, None, 2)]
    repeated = rows(schema, (W1, "a", 1), (W1, "a", 2))
    with pytest.raises(Exception, match="repeated"):
        ranking.pivot_unique(repeated, "w", "city", "n", ["a"]).collect()
