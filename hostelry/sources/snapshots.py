"""Versioned Parquet snapshots: ``<root>/<table>/run_ts=<YYYYMMDD_HHMMSS>/``."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import run_stamp

_STAMPED = re.compile(r"^run_ts=(\d{8}_\d{6})$")
_BARE = re.compile(r"^(\d{8}_\d{6})$")


@dataclass(frozen=True)
class Audit:
    """What one write did."""

    path: str
    rows: int
    schema: str


def _children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, is_folder) of the direct children; one listing on the driver."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(target):
        return []
    return [(s.getPath().getName(), s.isDirectory()) for s in files.listStatus(target)]


def _is_complete(spark: SparkSession, path: str) -> bool:
    return any(name == "_SUCCESS" for name, _ in _children(spark, path))


def resolve_latest(
    spark: SparkSession, root: str, table: str, allow_flat: bool = False,
    require_success: bool = True,
) -> str:
    """Folder of the newest snapshot.

    Stamped folders written here count only once their write has finished (turn
    ``require_success`` off where the committer leaves no marker); bare stamps
    from other writers count as they are.  ``allow_flat`` takes the table folder
    itself when files lie directly in it.
    """
    base = f"{root.rstrip('/')}/{table}"
    children = _children(spark, base)
    if allow_flat and any(not d and not n.startswith(("_", ".")) for n, d in children):
        return base
    found = []
    for name, is_folder in children:
        match = _STAMPED.match(name) or _BARE.match(name)
        if is_folder and match:
            found.append((match.group(1), name))
    for _, name in sorted(found, reverse=True):
        path = f"{base}/{name}"
        if _BARE.match(name) or not require_success or _is_complete(spark, path):
            return path
    raise FileNotFoundError(f"no snapshot of {table} under {root}")


def read_latest(
    spark: SparkSession, root: str, table: str, allow_flat: bool = False,
    schema: T.StructType | None = None, require_success: bool = True,
) -> DataFrame:
    """Newest snapshot; only its own folder is listed and read."""
    path = resolve_latest(spark, root, table, allow_flat, require_success)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_history(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All stamped snapshots with their ``run_ts``, pruned by filters on it."""
    base = f"{root.rstrip('/')}/{table}"
    return spark.read.option("basePath", base).parquet(f"{base}/run_ts=*")


def observed_write(df: DataFrame, path: str, write) -> Audit:
    """Run ``write(df)`` and count its rows in the same pass."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return Audit(path, int(seen.get.get("rows", 0)), df.schema.simpleString())


def write_snapshot(df: DataFrame, root: str, table: str, as_of: datetime) -> Audit:
    """Write one snapshot.  A rerun replaces its own folder, never another one."""
    path = f"{root.rstrip('/')}/{table}/run_ts={run_stamp(as_of)}"
    return observed_write(df, path, lambda d: d.write.mode("overwrite").parquet(path))
