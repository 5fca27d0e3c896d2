import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("hostelry-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(work / "warehouse"))
        .config("spark.checkpoint.dir", str(work / "shared"))
        .config("spark.driver.memory", "6g")
        .config("spark.default.parallelism", "2")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a frame from a schema string and tuples."""

    def build(schema, *data):
        return spark.createDataFrame(list(data), schema)

    return build


def collect(df, *order):
    """Rows as plain tuples, ordered by the given columns."""
    out = [tuple(r) for r in df.orderBy(*order).collect()] if order else [tuple(r) for r in df.collect()]
    return out
