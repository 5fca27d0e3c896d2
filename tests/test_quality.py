from conftest import collect

from hostelry.operators import quality
from hostelry.schemas import SOURCE_TABLES, TABLES


def by_check(df):
    return {(r["check"], r["column"]): (r.violations, r.rows) for r in df.collect()}


def test_not_null_and_length(rows):
    df = rows("id long, title string", (1, "abc"), (None, "日本"), (3, None), (4, "abcdef"))
    assert by_check(quality.not_null(df, ["id", "title"])) == {
        ("not_null", "id"): (1, 4), ("not_null", "title"): (1, 4)}
    assert by_check(quality.max_length(df, {"title": 5})) == {("max_length", "title"): (2, 4)}


def test_keys(rows):
    df = rows("a int, b int", (1, 1), (1, 1), (1, 1), (1, 2), (None, 3), (None, 3))
    assert collect(quality.duplicate_keys(df, ["a", "b"]), "n_rows") == [(None, 3, 2), (1, 1, 3)]
    assert collect(quality.duplicate_keys(df, ["a", "b"], ignore_nulls=True)) == [(1, 1, 3)]
    assert by_check(quality.unique_key(df, ["a", "b"])) == {("primary_key", "a,b"): (3, 6)}
    assert by_check(quality.unique_key(df, ["a"], "unique")) == {("unique", "a"): (3, 6)}
    assert by_check(quality.unique_key(df.limit(0), ["a"])) == {("primary_key", "a"): (0, 0)}


def test_orphans_with_hot_and_repeated_keys(rows):
    child = rows("k long", *[(7,)] * 50, (1,), (None,), (2,))
    parent = rows("id long", (1,), (1,), (2,))
    assert collect(quality.orphans(child, "k", parent, "id")) == [(7, 50)]
    assert by_check(quality.foreign_key(child, "k", parent, "id")) == {("foreign_key", "k"): (50, 53)}


def test_report_thresholds(spark, rows):
    apartments = spark.createDataFrame([(1, "x" * 300), (1, None), (2, "ok")], "id long, title string")
    from hostelry.operators.conform import conform
    frames = {"apartments": conform(apartments, TABLES["apartments"])}
    strict = {(r["check"], r["column"]): r for r in quality.report(frames, TABLES).collect()}
    assert strict[("primary_key", "id")].violations == 1 and not strict[("primary_key", "id")].passed
    assert strict[("not_null", "price")].rate == 1.0
    assert strict[("max_length", "title")].violations == 1
    assert strict[("not_null", "id")].passed
    loose = quality.report(frames, TABLES, {"primary_key": 0.5}, default_threshold=1.0)
    assert loose.where("NOT passed").count() == 0


def test_report_of_empty_tables(spark):
    frames = {t: spark.createDataFrame([], TABLES[t].schema) for t in SOURCE_TABLES}
    out = quality.report(frames, TABLES)
    assert out.where("NOT passed").count() == 0
    assert {r["table"] for r in out.collect()} == set(SOURCE_TABLES)


def test_profile(rows):
    df = rows("a int, b string", (1, None), (None, None))
    assert collect(quality.profile(df), "position") == [(1, "a", "int", 1, 2), (2, "b", "string", 0, 2)]
    assert quality.row_count(df).first().n_rows == 2


def test_numeric_summary(rows):
    df = rows("a int, b string, c double", (1, "x", 1.0), (2, "y", None), (3, None, 3.0))
    got = {r["column"]: r for r in quality.numeric_summary(df).collect()}
    assert set(got) == {"a", "c"}
    assert (got["a"].n, got["a"].mean, got["a"].std, got["a"].min, got["a"].max, got["a"].p50) == (3, 2.0, 1.0, 1.0, 3.0, 2.0)
    assert got["c"].n == 2


def test_census_equals_the_single_checks(spark):
    from functools import reduce

    from pyspark.sql import DataFrame

    from hostelry.operators.census import census
    from hostelry.sources.sample_tables import damaged_table
    frames = {t: damaged_table(spark, "/root/testdata/sf0.001", t) for t in SOURCE_TABLES}
    alone = reduce(DataFrame.unionByName, [quality.check_table(frames[t], TABLES[t], frames) for t in SOURCE_TABLES])
    assert sorted(collect(census(frames, TABLES))) == sorted(collect(alone))


def test_census_of_null_and_repeated_keys(spark):
    from hostelry.operators.census import census
    from hostelry.operators.conform import conform
    parents = conform(spark.createDataFrame([(1,), (1,), (None,), (None,), (3,)], "id long"), TABLES["apartments"])
    children = conform(
        spark.createDataFrame([(1, 1, 9), (2, 1, 9), (3, 2, None), (4, None, None)], "id long, apartment_id long, booking_id long"),
        TABLES["bookings"])
    got = {(r["table"], r["check"], r["column"]): (r.violations, r.rows)
           for r in census({"apartments": parents, "bookings": children}, TABLES).collect()}
    assert got[("apartments", "primary_key", "id")] == (2, 5)
    assert got[("bookings", "foreign_key", "apartment_id")] == (1, 4)


def test_report_scans_each_table_once(spark, tmp_path):
    from hostelry.sources.sample_tables import source_table
    frames = {}
    for t in SOURCE_TABLES:
        source_table(spark, "/root/testdata/sf0.001", t).write.parquet(str(tmp_path / t))
        frames[t] = spark.read.parquet(str(tmp_path / t))
    text = quality.report(frames, TABLES)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation [") == 2 * len(SOURCE_TABLES)  # the violations and the sizes read one aggregate
    out = quality.report(frames, TABLES)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("FileScan") == len(SOURCE_TABLES)
