"""Snapshots published through a manifest.

``<root>/<table>/data/<attempt>/`` has the rows, ``manifests/<attempt>/`` one row per file (rows, least and greatest
value of a column) and ``current.json`` names the attempt that readers see.  The pointer is replaced by a
rename after everything else is written, so readers see the old snapshot or the new one.  An
interrupted write leaves an attempt that nothing points to.  Reading lists no folder of snapshots, and
counts and newest values come from the manifest without a scan of the rows.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import run_stamp

POINTER = "current.json"


@dataclass(frozen=True)
class Snapshot:
    """What the pointer says: enough to read the rows without asking the files for their schema."""

    attempt: str
    taken: str
    rows: int
    files: int
    column: str  # whose extremes the manifest holds
    schema: str
    schema_hash: str
    previous_schema: str | None


def _base(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def schema_hash(schema: T.StructType) -> str:
    """Of names and types in order; comments and nullability do not count."""
    parts = [[f.name, f.dataType.simpleString()] for f in schema]
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()


def _read_text(spark: SparkSession, path: str) -> str | None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write beside, then rename over: the file is the old or the new one at any time."""
    jvm = spark._jvm
    hadoop, conf = jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    target, beside = hadoop.Path(path), hadoop.Path(f"{path}.{uuid.uuid4().hex}")
    stream = target.getFileSystem(conf).create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    kind = hadoop.Options.Rename
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    context = hadoop.FileContext.getFileContext(target.getFileSystem(conf).getUri(), conf)
    context.rename(beside, target, options)


def current(spark: SparkSession, root: str, table: str) -> Snapshot:
    """The published snapshot: one small file is read."""
    text = _read_text(spark, f"{_base(root, table)}/{POINTER}")
    if text is None:
        raise FileNotFoundError(f"no published snapshot of {table} under {root}")
    return Snapshot(**json.loads(text))


def stage(df: DataFrame, root: str, table: str, as_of: datetime) -> str:
    """Write the rows of a new attempt, which no reader sees; gives its name."""
    attempt = f"{run_stamp(as_of)}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(f"{_base(root, table)}/data/{attempt}")
    return attempt


def publish(spark: SparkSession, root: str, table: str, attempt: str, schema: T.StructType, column: str) -> Snapshot:
    """Write the manifest of an attempt, then point to it.

    The manifest is an aggregate of the written rows per file that reads ``column`` alone; it is a table
    itself, as its size grows with the files.  Empty tables have an empty manifest.
    """
    base = _base(root, table)
    rows = spark.read.schema(schema).parquet(f"{base}/data/{attempt}")
    per_file = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(column).alias("least"), F.max(column).alias("greatest")
    )
    path = f"{base}/manifests/{attempt}"
    per_file.write.parquet(path)
    told = spark.read.schema(per_file.schema).parquet(path).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("files")
    ).first()
    before = _read_text(spark, f"{base}/{POINTER}")
    snapshot = Snapshot(
        attempt, attempt.split("-")[0], told["rows"], told["files"], column, schema.json(), schema_hash(schema),
        json.loads(before)["schema"] if before else None,
    )
    _replace_text(spark, f"{base}/{POINTER}", json.dumps(asdict(snapshot)))
    return snapshot


def write_published(df: DataFrame, root: str, table: str, as_of: datetime, column: str) -> Snapshot:
    attempt = stage(df, root, table, as_of)
    return publish(df.sparkSession, root, table, attempt, df.schema, column)


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The rows that the pointer names, with the schema that it holds."""
    found = current(spark, root, table)
    schema = T.StructType.fromJson(json.loads(found.schema))
    return spark.read.schema(schema).parquet(f"{_base(root, table)}/data/{found.attempt}")


def manifest(spark: SparkSession, root: str, table: str) -> DataFrame:
    """(file, rows, least, greatest) of the published snapshot."""
    found = current(spark, root, table)
    kind = T.StructType.fromJson(json.loads(found.schema))[found.column].dataType.simpleString()
    schema = f"file string, rows bigint, least {kind}, greatest {kind}"
    return spark.read.schema(schema).parquet(f"{_base(root, table)}/manifests/{found.attempt}")


def newest(spark: SparkSession, root: str, table: str) -> Column:
    """The greatest value of the manifest's column as a literal, so that it prunes scans; the rows are not read."""
    return F.lit(manifest(spark, root, table).agg(F.max("greatest").alias("g")).first()["g"])


def drift(spark: SparkSession, root: str, table: str) -> DataFrame:
    """(column, before, after) where the published schema differs from the one before; nulls for absent columns."""
    found = current(spark, root, table)
    kinds = lambda text: {f.name: f.dataType.simpleString() for f in T.StructType.fromJson(json.loads(text))}
    after = kinds(found.schema)
    before = kinds(found.previous_schema) if found.previous_schema else after
    changed = [(c, before.get(c), after.get(c)) for c in [*before, *[c for c in after if c not in before]]
               if before.get(c) != after.get(c)]
    return spark.createDataFrame(changed, "column string, before string, after string")
