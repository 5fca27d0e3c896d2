from datetime import datetime
from pathlib import Path

import pytest
from conftest import collect

from hostelry.plans import jobs
from hostelry.schemas import SOURCE_TABLES
from hostelry.sources.csv import read_seed
from hostelry.sources.snapshots import Audit, read_latest

NOW = datetime(2024, 2, 1)

SEED = {
    "apartments.csv": "id,title,price,listing_created_on,is_active\n"
    "1,Flat,100,2024-01-01,1\n2,House,200,2024-01-09,0\n",
    "apartment_attributes.csv": "id,apartment_id,square_feet,cityname,state\n1,1,50,Rome,IT\n2,2,0,Oslo,NO\n",
    "user_viewing.csv": "id,user_id,apartment_id,viewed_at,is_wishlisted\n1,7,1,2024-01-02,true\n2,8,2,2024-01-20,false\n",
    "bookings.csv": "id,booking_id,user_id,apartment_id,booking_date,checkin_date,checkout_date,total_price,currency,booking_status\n"
    "1,11,7,1,2024-01-03,2024-01-05,2024-01-08,300,EUR,confirmed\n"
    "2,12,7,1,2024-01-20,2024-01-21,2024-01-22,100,,confirmed\n",
}


@pytest.fixture
def seed(tmp_path):
    folder = tmp_path / "seed"
    folder.mkdir()
    for name, text in SEED.items():
        Path(folder / name).write_text(text)
    return str(folder)


def test_whole_chain_on_csv(spark, seed, tmp_path):
    status = jobs.require_ok("seed", jobs.seed_from_csv(spark, seed, "tj_source"))
    assert {r.rows for r in status.collect()} == {2}
    lake = jobs.Lake(*(str(tmp_path / n) for n in ("raw", "processed", "metrics")), "tj_")
    done = jobs.run_pipeline(
        spark, lambda t: spark.table(f"tj_source.{t}"), lake, NOW, str(tmp_path / "layers"))
    got = {r.target: r.rows for r in done.collect()}
    assert len(got) == 4 + 4 + 4 + 3 + 1 + 6
    assert got["tj_curated.curated_user_activity"] == 4
    metrics = spark.table("tj_presentation.presentation_metrics").collect()
    assert len(metrics) == 1
    row = metrics[0]
    assert (row.total_listings, row.active_listings, row.total_booking_value) == (2, 1, 400.0)
    assert (row.booking_conversion_rate, row.etl_inserted_at) == (1.0, NOW)
    details = spark.table("tj_curated.curated_apartment_details")
    assert collect(details.select("apartment_id", "price_per_sqft"), "apartment_id") == [(1, 2.0), (2, 0.0)]
    assert {r.currency for r in spark.table("tj_raw_data.bookings").collect()} == {"USD"}
    ids = collect(spark.table("tj_curated.curated_user_activity").select("activity_id", "activity_date"), "activity_id")
    assert [i for i, _ in ids] == [1, 2, 3, 4] and [d for _, d in ids] == sorted(d for _, d in ids)
    history = spark.table("tj_presentation.pres_user_booking_history").orderBy("week_start_date").collect()
    assert [(r.total_bookings, r.favorite_city, r.is_repeat_customer) for r in history] == [
        (1, "Rome", False), (1, "Rome", True)]
    # A second run with a later stamp replaces every table and keeps the old snapshots.
    jobs.run_pipeline(spark, lambda t: spark.table(f"tj_source.{t}"), lake, datetime(2024, 2, 2))
    assert spark.table("tj_curated.curated_user_activity").count() == 4
    assert spark.table("tj_presentation.presentation_metrics").first().metrics_date.day == 2
    assert len(list((tmp_path / "raw" / "bookings").iterdir())) == 2


def test_failure_is_isolated_and_reported(spark, seed, tmp_path):
    def reader(table):
        if table == "bookings":
            raise OSError("unreachable")
        return read_seed(spark, seed, table)

    status = jobs.extract(spark, reader, str(tmp_path / "raw"), NOW)
    by_table = {r["table"]: r for r in status.collect()}
    assert by_table["bookings"].status == "failed" and "unreachable" in by_table["bookings"].error
    assert all(by_table[t].status == "ok" for t in SOURCE_TABLES if t != "bookings")
    with pytest.raises(jobs.StepFailed, match="bookings"):
        jobs.require_ok("extract", status)


def test_chain_stops_at_the_first_failed_step(spark, seed, tmp_path):
    lake = jobs.Lake(*(str(tmp_path / n) for n in ("raw", "processed", "metrics")), "tf_")
    with pytest.raises(jobs.StepFailed, match="extract"):
        jobs.run_pipeline(spark, lambda t: spark.table(f"nowhere.{t}"), lake, NOW, str(tmp_path / "l"))
    assert not (tmp_path / "processed").exists()


def test_lookback_limits(spark, seed, tmp_path):
    raw, processed, metrics = (str(tmp_path / n) for n in ("raw", "processed", "metrics"))
    days = {"apartments": 25, "user_viewings": 20, "bookings": 15}
    jobs.extract(spark, lambda t: read_seed(spark, seed, t), raw, NOW, days=days)
    got = {t: read_latest(spark, raw, t).count() for t in SOURCE_TABLES}
    assert got == {"apartments": 1, "apartment_attributes": 2, "user_viewings": 1, "bookings": 1}
    jobs.extract(spark, lambda t: read_seed(spark, seed, t), raw, NOW)
    jobs.require_ok("transform", jobs.transform_all(spark, raw, processed, NOW))
    jobs.create_layers(spark, "tw_", str(tmp_path / "layers"))
    jobs.require_ok("metrics", jobs.generate_metrics(spark, processed, metrics, NOW, "tw_", days=15))
    row = spark.table("tw_presentation.presentation_metrics").first()
    assert (row.total_listings, row.total_viewings, row.total_bookings) == (2, 1, 1)


def test_rows_can_go_to_another_sink(spark, seed, tmp_path):
    raw, processed, metrics = (str(tmp_path / n) for n in ("raw", "processed", "metrics"))
    jobs.require_ok("extract", jobs.extract(spark, lambda t: read_seed(spark, seed, t), raw, NOW))
    jobs.require_ok("transform", jobs.transform_all(spark, raw, processed, NOW))
    taken = {}

    def sink(df, table):
        taken[table] = df.count()
        return Audit(f"warehouse/{table}", taken[table], "")

    for status in (jobs.load_raw(spark, raw, NOW, sink=sink), jobs.load_curated(spark, processed, NOW, sink=sink),
                   jobs.generate_metrics(spark, processed, metrics, NOW, sink=sink)):
        assert {r.target.split("/")[0] for r in jobs.require_ok("load", status).collect()} == {"warehouse"}
    assert taken == {"apartments": 2, "apartment_attributes": 2, "user_viewings": 2, "bookings": 2, "curated_apartments": 2,
                     "curated_apartment_details": 2, "curated_user_activity": 4, "presentation_metrics": 1}


def test_fan_out_keeps_order(spark):
    status = jobs.fan_out(spark, ["b", "a"], lambda n: Audit(n, 1, ""))
    assert [r["table"] for r in status.collect()] == ["b", "a"]
