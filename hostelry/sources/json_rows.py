"""Rows as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import iso_text

_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def rows_to_json(df: DataFrame, name: str = "json") -> DataFrame:
    """One JSON object per row: ISO dates, decimals as numbers, nulls kept."""

    def plain(f: T.StructField):
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, _TIMES):
            value = iso_text(value, f.dataType)
        elif isinstance(f.dataType, T.DecimalType):
            value = value.cast("double")
        return value.alias(f.name)

    row = F.struct(*[plain(f) for f in df.schema])
    return df.select(F.to_json(row, {"ignoreNullFields": "false"}).alias(name))
