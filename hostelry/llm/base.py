"""What the operators of this folder share: reading, row keys, names, scratch tables."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import configure, scratch_path

# The white space of the text contracts: space and the five control characters \t to \r.
BLANKS = r"[\x20\x09-\x0D]"

# Rows of one Arrow batch; a batch of long texts stays in the tens of megabytes.
BATCH_ROWS = 1000


def session(spark: SparkSession, batch_rows: int = BATCH_ROWS) -> SparkSession:
    """The session with the settings these operators rely on.

    Bounded Arrow batches (of more rows where a step passes only short ones), and shuffle files that go when a stored step has been
    written, so that an operator of many steps needs the disk of its largest one.
    """
    _ship_package(spark)
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


_shipped: set[str] = set()


def _ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application: their Python imports it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as code:
        for source in sorted(package.rglob("*.py")):
            code.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def ship_file(spark: SparkSession, path: str) -> str:
    """Send a file of the driver to the executors, for ``shipped_file``; files of one name must be equal."""
    name = Path(path).name
    if not any(f.endswith(f"/{name}") for f in spark.sparkContext.listFiles):
        spark.sparkContext.addFile(path)
    return name


def shipped_file(name: str) -> str:
    """The place of a file of ``ship_file`` in a task."""
    return SparkFiles.get(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One whole table of a data folder."""
    return session(spark).read.parquet(f"{folder}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def id_key(column: str = "doc_id") -> Column:
    """The id as a long that is never null, for joins."""
    return F.coalesce(F.col(column).cast("long"), F.lit(-(2**63)))


def text_key(column: str = "text") -> Column:
    """Tells rows of one doc_id apart that hold different texts.

    (id_key, text_key) names a row for joining results back to texts; rows that
    agree in both have the same input, so they get the same result.
    """
    return F.xxhash64(whole_text(column))


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % folds


def stored(df: DataFrame, name: str, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage: later passes survive lost executors without recomputing, and
    ids made by ``numbered`` stay as they were written.
    """
    path = scratch_path(session(df.sparkSession, batch_rows), name)
    df.write.parquet(path)
    session(df.sparkSession)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.stored_at = path
    return written


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing reads any more."""
    for table_ in tables:
        context = table_.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table_.stored_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def numbered(df: DataFrame, order: list[str], name: str, ranges: int | None = None) -> DataFrame:
    """A stored copy of ``df`` with a distinct integer ``name`` that follows ``order``.

    The frame is range-partitioned and sorted; an id is the partition number and the
    position in it, so no task sees more than its range.  Neighbouring ranges of a small
    frame may be put together, to ``ranges`` at most.
    """
    sorted_ = df.orderBy(*order).coalesce(ranges) if ranges else df.orderBy(*order)
    return stored(sorted_.withColumn("name", F.monotonically_increasing_id()), name)


def keep_rows(docs: DataFrame, kept: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` named by ``kept`` (id_key, text_key), all columns as they were.

    Of rows that repeat one id and text a single one stays.  The key columns get names
    that no column of ``docs`` has.
    """
    a, b, n = (free_name(docs, x) for x in ("_id_key", "_text_key", "_copy"))
    keyed = docs.withColumns({a: id_key(id_column), b: text_key(text_column)})
    wanted = kept.select(F.col("id_key").alias(a), F.col("text_key").alias(b)).distinct()
    copies = Window.partitionBy(a, b).orderBy(a)
    found = keyed.join(wanted, [a, b], "left_semi").withColumn(n, F.row_number().over(copies))
    return found.where(F.col(n) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
