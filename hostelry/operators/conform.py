"""Type conformance and text clipping against a declared schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.columns import clip_bytes_sql
from ..schemas import Table

_WHOLE = (T.LongType, T.IntegerType)


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _converted(name: str, source: T.DataType, target: T.DataType) -> str:
    """SQL for the column as ``target``; null when the value does not fit."""
    column = _quoted(name)
    if source == target:
        return column
    if isinstance(source, T.StringType) and isinstance(target, (*_WHOLE, T.BooleanType)):
        # Whole numbers and flags often arrive as "3.0" once a column had gaps.
        column = f"regexp_replace(trim({column}), '[.]0+$', '')"
    return f"try_cast({column} AS {target.simpleString()})"


def conform(df: DataFrame, table: Table, keep_extra: bool = False) -> DataFrame:
    """Give ``df`` the table's columns, order and types.

    Missing columns become typed nulls and values that do not convert become
    null.  ``keep_extra`` keeps undeclared columns after the declared ones.
    """
    have = {f.name: f.dataType for f in df.schema}
    out = []
    for f in table.schema:
        if f.name in have:
            value = _converted(f.name, have[f.name], f.dataType)
        else:
            value = f"CAST(NULL AS {f.dataType.simpleString()})"
        out.append(f"{value} AS {_quoted(f.name)}")
    if keep_extra:
        declared = set(table.schema.names)
        out += [_quoted(name) for name in have if name not in declared]
    return df.selectExpr(*out)


def lost_values(df: DataFrame, table: Table) -> DataFrame:
    """Per column: non-null inputs that conformance turned into null."""
    have = {f.name: f.dataType for f in df.schema}
    counts = [
        f"struct('{f.name}' AS column, count_if({_quoted(f.name)} IS NOT NULL AND "
        f"{_converted(f.name, have[f.name], f.dataType)} IS NULL) AS violations)"
        for f in table.schema
        if f.name in have
    ]
    one_row = df.selectExpr(f"array({', '.join(counts)}) AS checks", "count(1) AS rows")
    return one_row.selectExpr("rows", "inline(checks)").select("column", "violations", "rows")


def truncate_columns(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Clip text columns to their byte limits; other columns pass through."""
    return df.selectExpr(
        *[
            f"{clip_bytes_sql(_quoted(c), limits[c])} AS {_quoted(c)}" if c in limits else _quoted(c)
            for c in df.columns
        ]
    )
