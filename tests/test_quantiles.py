"""Exact quantiles against numpy, with ranges so narrow that every way is taken."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hostelry.operators import quantiles as Q
from hostelry.operators.quality import numeric_summary


def _check(df, columns, shares, **settings):
    table = df.select(*columns).toPandas()
    found = {(r["column"], r["share"]): r["value"] for r in Q.exact_quantiles(df, columns, shares, **settings).collect()}
    expected = {}
    for c in columns:
        values = table[c].dropna().to_numpy(float)
        for q in shares if len(values) else ():
            expected[c, q] = np.quantile(values, q)
    assert found.keys() == expected.keys()
    for key, value in expected.items():
        assert found[key] == pytest.approx(value, rel=1e-12, abs=1e-12), key


@pytest.fixture(scope="module")
def table(spark):
    spread = F.exp(F.randn(3) * 5)
    return spark.range(0, 20_000, 1, 4).select(
        (F.rand(1) * 1e6).alias("even"), spread.alias("skewed"), F.col("id").alias("id"), (F.col("id") % 7).cast("int").alias("few"),
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.randn(2)).alias("heavy"), F.lit(2.5).alias("one"),
        F.when(F.col("id") % 10 == 0, F.randn(4)).alias("gaps"), F.lit(None).cast("double").alias("none"),
        F.when(F.col("id") % 2 == 0, F.lit(float("nan"))).otherwise(F.col("id") * -1.0).alias("nans"), (F.col("id") % 2).alias("two"),
    ).cache()


COLUMNS = ["even", "skewed", "id", "few", "heavy", "one", "gaps", "none", "nans", "two"]
SHARES = (0.0, 0.001, 0.25, 0.5, 0.75, 0.9999, 1.0)


@pytest.mark.parametrize("columns, settings", [
    (COLUMNS, {}), (COLUMNS, {"small": 0, "accuracy": 200}), (["even", "heavy", "two"], {"small": 0, "accuracy": 100, "rows_at_once": 50}),
])
def test_quantiles_equal_sorting(table, columns, settings):
    _check(table, columns, SHARES, **settings)


def test_ranges_are_narrowed_before_values_are_counted(table):
    stats = Q.first_pass(table, ["even"], (0.5,), 100, 0)
    before = stats[0].ranges[0].high - stats[0].ranges[0].low
    Q._narrow(table, stats, 100, 50)
    after = stats[0].ranges[0].high - stats[0].ranges[0].low
    assert after < before / 2
    v = F.col("even")
    held = table.agg(F.count_if((v >= stats[0].ranges[0].low) & (v <= stats[0].ranges[0].high))).first()[0]
    assert 0 < held <= 2000


@pytest.mark.parametrize("n", [1, 2, 10])
def test_few_rows(spark, n):
    _check(spark.range(n).selectExpr("id * 1.5D AS x", "cast(id AS decimal(10,2)) AS d"), ["x", "d"], SHARES)
    _check(spark.range(n).selectExpr("id * 1.5D AS x"), ["x"], SHARES, small=0, accuracy=10)


def test_summary(table, spark):
    found = {r["column"]: r for r in numeric_summary(table).collect()}
    assert set(found) == set(COLUMNS) and found["none"]["n"] == 0 and found["none"]["p50"] is None
    assert (found["id"]["p25"], found["id"]["p50"], found["id"]["min"]) == (4999.75, 9999.5, 0.0)
    assert found["nans"]["n"] == 10_000
    assert numeric_summary(spark.createDataFrame([], "a string, b double, c int")).where("p50 IS NULL AND n = 0").count() == 2
    assert numeric_summary(spark.createDataFrame([("x",)], "a string")).collect() == []


def test_two_passes(spark, tmp_path):
    """The second pass reads the table once, for all columns."""
    spark.range(1000).selectExpr("id", "id * 2 AS b").write.parquet(str(tmp_path / "t"))
    text = numeric_summary(spark.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1
