import pytest
from conftest import collect
from pyspark.sql import functions as F

from hostelry.queries import queries
from hostelry.sources import hot_keys

BUCKETS = 8


@pytest.fixture
def sides(spark):
    """A key and null hold a third of the rows each; key 3 has no partner."""
    key = "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id % 200 END"
    large = spark.range(6000).selectExpr("id", f"{key} AS k")
    return large, spark.range(200).where("id <> 3").selectExpr("id AS k", "concat('n', id) AS name")


def test_heavy_keys_are_exact_and_few(sides):
    heavy = {r.k: r.splits for r in hot_keys.heavy_keys(sides[0], "k", BUCKETS).collect()}
    assert set(heavy) == {7, None} and all(s >= BUCKETS // 2 for s in heavy.values())
    assert hot_keys.heavy_keys(sides[0].limit(0), "k", BUCKETS).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_keeps_the_rows_and_needs_no_shuffle(spark, sides, how):
    large, small = sides
    spark.sql("CREATE DATABASE IF NOT EXISTS hot")
    heavy = hot_keys.write_pair(large, small, "k", BUCKETS, f"hot.large_{how}", f"hot.small_{how}")
    assert heavy.count() == 2
    joined = hot_keys.join_salted(spark.table(f"hot.large_{how}"), spark.table(f"hot.small_{how}"), "k", how)
    expected = large.join(small, "k", how).select("k", "id", "name")
    assert collect(joined.select("k", "id", "name"), "id") == collect(expected, "id")
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_hot_key_is_read_by_several_tasks(spark, sides):
    spark.sql("CREATE DATABASE IF NOT EXISTS hot")
    hot_keys.write_pair(*sides, "k", BUCKETS, "hot.large_t", "hot.small_t")
    joined = hot_keys.join_salted(spark.table("hot.large_t"), spark.table("hot.small_t"), "k")
    per_task = joined.where("k = 7").groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"))
    counts = [n for _, n in collect(per_task)]
    assert sum(counts) == 2000 + 10 and len(counts) >= 3 and max(counts) < 1400


def test_outer_sides_are_refused(sides):
    with pytest.raises(ValueError):
        hot_keys.join_salted(*sides, "k", "full")


def test_registered_join_has_no_shuffle(spark):
    text = queries()["hot_key_join"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Exchange" not in text
