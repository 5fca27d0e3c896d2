from datetime import datetime

import pytest
from conftest import collect

from hostelry.functions.columns import clip_bytes_sql
from hostelry.operators.conform import conform, lost_values, truncate_columns
from hostelry.schemas import TABLES


def test_flags_from_numbers_and_text(rows):
    for schema, data in [
        ("id int, is_active int", [(1, 1), (2, 0), (3, None)]),
        ("id string, is_active string", [("1", "true"), ("2", "0.0"), ("3", "maybe")]),
        ("id string, is_active string", [("1", "1.0"), ("2", "False"), ("3", None)]),
    ]:
        out = conform(rows(schema, *data), TABLES["apartments"]).select("id", "is_active")
        assert collect(out, "id") == [(1, True), (2, False), (3, None)]


def test_whole_numbers_from_float_text(rows):
    df = rows("id string, num_guests string", ("1", "3.0"), ("2", "3.7"), ("3", " 4 "), ("4", "x"))
    out = conform(df, TABLES["bookings"]).select("id", "num_guests")
    assert collect(out, "id") == [(1, 3), (2, None), (3, 4), (4, None)]


def test_missing_columns_are_typed_nulls_and_extras_optional(rows):
    df = rows("id long, price double, mood string", (1, 2.0, "x"))
    plain = conform(df, TABLES["apartments"])
    assert plain.columns == TABLES["apartments"].schema.names
    assert dict(plain.dtypes)["listing_created_on"] == "timestamp"
    assert conform(df, TABLES["apartments"], keep_extra=True).columns[-1] == "mood"


def test_timestamps_from_text_and_wall_clock(spark, rows):
    df = rows("id long, viewed_at string", (1, "2024-01-02 03:04:05"), (2, "soon"))
    out = conform(df, TABLES["user_viewings"]).select("id", "viewed_at")
    assert collect(out, "id") == [(1, datetime(2024, 1, 2, 3, 4, 5)), (2, None)]
    ntz = spark.sql("SELECT 1L AS id, timestamp_ntz'2024-01-02 03:04:05' AS viewed_at")
    assert conform(ntz, TABLES["user_viewings"]).first().viewed_at == datetime(2024, 1, 2, 3, 4, 5)


def test_lost_values_counts_only_failed_conversions(rows):
    df = rows("id string, num_guests string", ("1", "2"), ("x", "two"), (None, None))
    out = {r["column"]: r.violations for r in lost_values(df, TABLES["bookings"]).collect()}
    assert out == {"id": 1, "num_guests": 1}


@pytest.mark.parametrize("text", [
    "plain ascii", "é" * 10, "aé" * 7, "日本語テキスト", "x日" * 5, "😀😀😀", "a😀b", "", "é日😀z",
])
def test_clip_keeps_whole_characters(spark, text):
    for limit in range(1, len(text.encode()) + 2):
        expected = text
        while len(expected.encode()) > limit:
            expected = expected[:-1]
        df = spark.createDataFrame([(text,)], "t string")
        assert df.selectExpr(f"{clip_bytes_sql('t', limit)} AS t").first().t == expected


def test_truncate_columns_touches_only_limited_columns(rows):
    df = rows("a string, b string, n int", ("abcdef", "abcdef", 1), (None, "x", 2))
    out = truncate_columns(df, {"a": 3, "missing": 2})
    assert collect(out, "n") == [("abc", "abcdef", 1), (None, "x", 2)]
