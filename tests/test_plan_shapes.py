"""The physical plans keep the shapes that large data needs."""

import re
from datetime import datetime

import pytest
from conftest import collect
from pyspark.sql import functions as F

from hostelry.operators.periods import lookback
from hostelry.operators.repeat import rolling_counts
from hostelry.plans import engagement, rental
from hostelry.queries import Data, queries
from hostelry.schemas import TABLES

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_n_is_pruned_before_the_shuffle(spark):
    text = plan(rental.top_listings(*Data(spark, SMALL).places))
    assert len(re.findall("WindowGroupLimit", text)) == 2  # partial and final


@pytest.fixture
def stored_activity(spark, tmp_path):
    Data(spark, SMALL).activity.drop("source_id").write.partitionBy("activity_type").parquet(str(tmp_path / "a"))
    schema = ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in TABLES["curated_user_activity"].schema
        if f.name != "activity_id")
    return spark.read.schema(schema).parquet(str(tmp_path / "a"))


def test_scans_are_pruned(spark, stored_activity):
    details = Data(spark, SMALL).details
    since = F.lit("1998-01-05").cast("date")
    text = plan(engagement.user_booking_history(stored_activity, details, since=since))
    scans = [s for s in text.split("FileScan")[1:] if "activity_date" in s]
    assert scans and all("activity_type" in s.split("PartitionFilters")[1] for s in scans)
    assert all("GreaterThanOrEqual(activity_date" in s for s in scans)
    assert "call_to_action" not in text and "payment_status" not in text


def test_engagement_groups_users_once(spark, stored_activity):
    text = plan(engagement.user_engagement(stored_activity))
    # by (user, day), by user for the windows, by week; the (user, week) step stays local
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 3


def test_hot_listing_is_split(spark, tmp_path):
    """A listing with a third of all bookings is joined by several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",  # several map tasks
        "spark.sql.shuffle.partitions": "8",
    }
    n = 30000
    spark.range(n).selectExpr(
        "id AS user_id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 500 END AS apartment_id",
        "timestamp'2024-01-01' AS activity_date", "'booking' AS activity_type",
    ).write.parquet(str(tmp_path / "b"))
    spark.range(500).selectExpr("id AS apartment_id", "concat('c', id) AS city").write.parquet(str(tmp_path / "d"))
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = engagement.favorite_cities(
            spark.read.parquet(str(tmp_path / "b")), spark.read.parquet(str(tmp_path / "d")))
        found = out.groupBy("favorite_city").agg(F.count(F.lit(1)).alias("n"))
        counts = dict(collect(found))
        assert sum(counts.values()) == n and counts["c0"] >= n // 3
        found.collect()
        assert "skew=true" in plan(found)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def scanned_rows(df):
    """Rows that the file scans of a plan gave, after it ran."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        else:
            if name.startswith("Scan"):
                total += node.metrics().apply("numOutputRows").value()
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return total


def test_time_bounds_skip_stored_rows(spark, tmp_path):
    """Files sorted by time are read from the bound on only."""
    data = Data(spark, "/root/testdata/sf0.01")
    activity = data.activity.drop("source_id").repartitionByRange(16, "activity_date").sortWithinPartitions("activity_date")
    activity.write.parquet(str(tmp_path / "a"))
    stored = spark.read.parquet(str(tmp_path / "a"))
    n = stored.count()
    recent = lookback(stored, "activity_date", datetime(1998, 6, 30), 30).select("activity_date")
    assert 0 < recent.count() <= scanned_rows(recent) < n / 4
    since = data.latest_week(stored)
    history = engagement.user_booking_history(stored, data.details.limit(0), since=since)
    assert history.count() > 0
    week = stored.where(F.col("activity_date") >= since.cast("timestamp")).select("activity_date")
    assert 0 < week.count() <= scanned_rows(week) < n / 8


def test_rolling_count_shuffles_its_steps_once(spark):
    df = Data(spark, SMALL).raw("bookings").select("id", "user_id", "booking_date")
    out = rolling_counts(df)
    out.collect()
    assert "ReusedExchange" in plan(out)


def test_bucketed_join_has_no_shuffle_before_the_join(spark):
    text = plan(queries()["bucketed_join"](spark, SMALL))
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_performance_reads_the_listings_twice(spark, stored_activity, tmp_path):
    """Once for the stored supply, which serves counts, prices and medians, and once for the occupied nights."""
    data = Data(spark, SMALL)
    listed, detailed = str(tmp_path / "listed"), str(tmp_path / "detailed")
    data.apartments.write.parquet(listed)
    data.details.write.parquet(detailed)
    frames = spark.read.parquet(listed), spark.read.parquet(detailed)
    text = rental.rental_performance(*frames, stored_activity)._jdf.queryExecution().optimizedPlan().toString()
    # The second read is for the flag and the date; the details are in the supply already.
    assert len(re.findall(r"Relation \[[^\]]*listing_created_on", text)) == 1
    assert not re.search(r"Relation \[[^\]]*price_per_sqft", text)
