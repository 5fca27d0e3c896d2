"""CSV seed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.conform import conform
from ..operators.enrich import with_constant_currency
from ..schemas import TABLES

# File name of each seed table.
CSV_FILES = {
    "apartments": "apartments.csv",
    "apartment_attributes": "apartment_attributes.csv",
    "user_viewings": "user_viewing.csv",
    "bookings": "bookings.csv",
}

# Seed tables with free text, whose fields may hold line breaks.
FREE_TEXT = {"apartments", "apartment_attributes"}

# Texts that common CSV readers take as missing.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_text_columns(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Columns by header name, all text, missing markers as null.

    ``multi_line`` accepts quoted line breaks and reads one file per task; turn
    it off for files known to have none, so that large files split.
    """
    df = spark.read.csv(path, header=True, multiLine=multi_line, quote='"', escape='"')
    return df.select(
        *[F.when(~F.col(f"`{c}`").isin(MISSING_TEXTS), F.col(f"`{c}`")).alias(c) for c in df.columns]
    )


def read_csv(spark: SparkSession, path: str, table: str, multi_line: bool = True) -> DataFrame:
    """Seed file conformed to its source table; undeclared columns stay text."""
    return conform(read_text_columns(spark, path, multi_line), TABLES[table], keep_extra=True)


def read_seed(spark: SparkSession, folder: str, table: str, multi_line: bool = True) -> DataFrame:
    """One of the four seed files, bookings with the constant currency."""
    df = read_csv(spark, f"{folder.rstrip('/')}/{CSV_FILES[table]}", table, multi_line)
    return with_constant_currency(df) if table == "bookings" else df
