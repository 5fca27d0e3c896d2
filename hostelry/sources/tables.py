"""Warehouse tables: full refresh, physical layout, SQL access."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import as_of_literal
from ..operators.conform import conform, truncate_columns
from ..schemas import TABLES, Table, qualified
from .snapshots import Audit, observed_write


def lay_out(df: DataFrame, table: Table) -> DataFrame:
    """Order rows by the declared sort key before a write.

    Range partitioning on the whole sort key gives narrow min/max ranges per
    file; the key columns break ties, so one frequent value spreads over many
    files.  Tables bounded by the calendar go to one sorted file.
    """
    order = [c for c in table.order if c in df.columns]
    if not order:
        return df
    if table.spread == "ALL":
        return df.repartition(1).sortWithinPartitions(*order)
    lead = [*table.partition_by, *[c for c in order if c not in table.partition_by]]
    tiebreak = [c for c in table.key if c in df.columns and c not in lead]
    if not table.partition_by:
        return df.repartitionByRange(*lead, *tiebreak).sortWithinPartitions(*lead)
    return into_partitions(df, *lead, *tiebreak).sortWithinPartitions(*lead)


def into_partitions(df: DataFrame, *order: str) -> DataFrame:
    """Ranges of ``order``, as many as shuffle partitions however few the rows are.

    For tables with a folder per period: a task opens one file per folder, one after another,
    so a range that holds all of them would keep the others waiting.
    """
    return df.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order)


def refresh_table(
    df: DataFrame, table: str, as_of: datetime, prefix: str = "", arrange: bool = False
) -> Audit:
    """Replace all rows of a declared table, clipping text to its limits.

    ``etl_inserted_at`` defaults to the load time where the rows carry none.
    ``arrange`` sorts the files by the declared sort key, at the price of a
    shuffle; without it the rows are written as they come.
    """
    spec = TABLES[table]
    name = qualified(table, prefix)
    spark = df.sparkSession
    loaded = conform(df, spec).withColumn(
        "etl_inserted_at", F.coalesce("etl_inserted_at", as_of_literal(as_of))
    )
    ready = truncate_columns(loaded, spec.text_limits)
    if arrange:
        ready = lay_out(ready, spec)
    target = spark.table(name).columns  # partition columns last
    return observed_write(
        ready.select(*target), name, lambda d: d.write.insertInto(name, overwrite=True)
    )


def replace_table(df: DataFrame, name: str) -> Audit:
    """Drop and recreate a table from a frame, types as they are."""
    return observed_write(
        df, name, lambda d: d.write.mode("overwrite").format("parquet").saveAsTable(name)
    )


def write_bucketed(
    df: DataFrame, name: str, key: str, buckets: int, order: list[str] | None = None,
    splits: int = 4,
) -> None:
    """Table hash-distributed on ``key`` so that joins on it need no shuffle.

    Each bucket is written by up to ``splits`` tasks, so a key with a large
    share of the rows does not end up in a single task.
    """
    bucket = F.pmod(F.hash(key), F.lit(buckets))
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(splits))
    writer = df.repartition(buckets * splits, bucket, spread).write.mode("overwrite")
    writer.format("parquet").bucketBy(buckets, key).sortBy(*(order or [key])).saveAsTable(name)


def spread_evenly(df: DataFrame, partitions: int) -> DataFrame:
    """Round-robin distribution."""
    return df.repartition(partitions)


def warehouse_sql(spark: SparkSession, query: str) -> DataFrame:
    """Result of a query over the registered tables; errors are raised."""
    return spark.sql(query)


# Report columns and order over the presentation tables.
_REPORT_ORDER = {
    "pres_rental_performance_weekly": "week_start_date",
    "pres_rental_performance_monthly": "month_start_date",
    "pres_popular_locations_weekly": "week_start_date, total_bookings DESC, city, state",
    "pres_top_listings_weekly": "week_start_date, total_revenue DESC, apartment_id",
    "pres_user_engagement_weekly": "week_start_date",
    "pres_user_booking_history": "week_start_date, user_id",
}


def report_table(spark: SparkSession, table: str, prefix: str = "") -> DataFrame:
    """A presentation table without load columns, in reading order."""
    columns = ", ".join(c for c in TABLES[table].schema.names if c != "etl_inserted_at")
    order = _REPORT_ORDER[table]
    return warehouse_sql(spark, f"SELECT {columns} FROM {qualified(table, prefix)} ORDER BY {order}")
