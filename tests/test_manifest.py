from datetime import datetime

import pytest
from conftest import collect
from pyspark.sql import functions as F

from hostelry.sources import manifest

FIRST, SECOND = datetime(2024, 1, 1), datetime(2024, 1, 2)


@pytest.fixture
def df(spark):
    return spark.range(0, 100, 1, 4).select("id", F.expr("timestamp'2024-01-01' + make_interval(0,0,0,id) AS at"))


def test_readers_see_published_snapshots_only(spark, df, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        manifest.read_published(spark, root, "t")
    attempt = manifest.stage(df, root, "t", FIRST)
    with pytest.raises(FileNotFoundError):  # written, but nothing points to it
        manifest.read_published(spark, root, "t")
    manifest.publish(spark, root, "t", attempt, df.schema, "at")
    manifest.stage(df.limit(3), root, "t", SECOND)  # interrupted
    assert manifest.read_published(spark, root, "t").count() == 100
    found = manifest.write_published(df.where("id < 10"), root, "t", SECOND, "at")
    assert (found.rows, found.taken) == (10, "20240102_000000")
    assert manifest.current(spark, root, "t") == found
    assert collect(manifest.read_published(spark, root, "t").select("id"), "id") == [(i,) for i in range(10)]


def test_an_open_read_keeps_its_snapshot(spark, df, tmp_path):
    root = str(tmp_path)
    manifest.write_published(df, root, "t", FIRST, "id")
    before = manifest.read_published(spark, root, "t")
    manifest.write_published(df.limit(1), root, "t", FIRST, "id")  # the same time again
    assert before.count() == 100


def test_manifest_holds_extremes_per_file(spark, df, tmp_path):
    root = str(tmp_path)
    assert manifest.write_published(df, root, "t", FIRST, "id").files == 4
    got = manifest.manifest(spark, root, "t")
    assert [tuple(r)[1:] for r in got.orderBy("least").collect()] == [(25, 0, 24), (25, 25, 49), (25, 50, 74), (25, 75, 99)]
    assert spark.range(1).select(manifest.newest(spark, root, "t")).first()[0] == 99


def test_drift_of_columns_and_types(spark, df, tmp_path):
    root = str(tmp_path)
    manifest.write_published(df, root, "t", FIRST, "id")
    assert manifest.drift(spark, root, "t").count() == 0
    changed = df.select(F.col("id").cast("int").alias("id"), F.lit("x").alias("name"))
    manifest.write_published(changed, root, "t", SECOND, "id")
    assert collect(manifest.drift(spark, root, "t"), "column") == [
        ("at", "timestamp", None), ("id", "bigint", "int"), ("name", None, "string")]
    assert manifest.schema_hash(df.schema) != manifest.schema_hash(changed.schema)


def test_empty_table(spark, df, tmp_path):
    found = manifest.write_published(df.limit(0), str(tmp_path), "t", FIRST, "id")
    assert found.rows == 0 and manifest.read_published(spark, str(tmp_path), "t").columns == ["id", "at"]
    assert spark.range(1).select(manifest.newest(spark, str(tmp_path), "t")).first()[0] is None
