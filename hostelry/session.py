"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan in this package relies on.  UTC makes calendar
# bucketing reproducible; adaptive execution sizes shuffles and splits hot keys;
# microsecond timestamps have min/max in Parquet files, so time bounds skip data.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

_local_scratch: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of its own machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        app = context.applicationId
        if app not in _local_scratch:
            _local_scratch[app] = tempfile.mkdtemp(prefix="hostelry-")
        root = _local_scratch[app]
    return f"{root.rstrip('/')}/hostelry-{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the scratch area and read it back.

    Used where a result feeds several passes: the written copy survives lost
    executors and is not recomputed by the later passes.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
