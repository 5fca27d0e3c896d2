"""Scalar expressions shared by the operators and plans."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Money is summed as decimal: the result does not depend on the order in which
# tasks finish, so a rerun after a lost executor gives the same digits.
MONEY = "decimal(24,6)"


def as_of_literal(as_of: datetime) -> Column:
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def run_stamp(as_of: datetime) -> str:
    """Snapshot stamp ``YYYYMMDD_HHMMSS``."""
    return as_of.strftime("%Y%m%d_%H%M%S")


def money(value: Column) -> Column:
    """Decimal view of a float amount; NaN counts as missing."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double")).cast(MONEY)


def guarded_ratio(numerator: Column, denominator: Column, scale: float = 1.0) -> Column:
    """``scale * n / d``, 0 when the divisor is not positive."""
    ratio = F.lit(scale) * numerator.cast("double") / denominator.cast("double")
    return F.when(denominator > 0, ratio).otherwise(F.lit(0.0))


def percent_change(change: Column, base: Column) -> Column:
    """Change in percent of the base; null without a usable base."""
    return F.try_divide(change, base) * 100


def city_label(city: Column, state: Column) -> Column:
    """``City, State``; null when either part is missing."""
    return F.concat(city, F.lit(", "), state)


def day_text(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def fixed_decimals(value: Column, digits: int = 2) -> Column:
    """Plain fixed-point text, no thousands separators; null stays null."""
    text = F.format_string(f"%.{digits}f", value.cast("double"))
    return F.when(value.isNotNull(), text)


def clip_bytes_sql(column: str, limit: int) -> str:
    """SQL for the longest prefix of whole characters within ``limit`` UTF-8 bytes.

    A UTF-8 character has at most 4 bytes, so the cut moves back by at most 3
    positions until the first dropped byte is not a continuation byte.
    """
    raw = f"CAST({column} AS BINARY)"
    cuts = [max(limit - back, 0) for back in range(4)]
    tries = " ".join(
        f"WHEN hex(substring({raw}, {keep + 1}, 1)) NOT BETWEEN '80' AND 'BF' "
        f"THEN CAST(substring({raw}, 1, {keep}) AS STRING)"
        for keep in cuts[:3]
    )
    return (
        f"CASE WHEN octet_length({column}) <= {limit} THEN {column} {tries} "
        f"ELSE CAST(substring({raw}, 1, {cuts[3]}) AS STRING) END"
    )


def iso_text(value: Column, data_type: T.DataType) -> Column:
    """ISO text of a date or timestamp; microseconds only when present."""
    if isinstance(data_type, T.DateType):
        return day_text(value)
    whole = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(value, "SSSSSS")
    return F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))


def period_start(value: Column, grain: str = "week", week_start: str = "MON") -> Column:
    """First day of the week or month that holds ``value``."""
    if grain == "month":
        return F.trunc(value, "month")
    if grain != "week":
        raise ValueError(f"unknown grain {grain!r}")
    if week_start == "MON":
        return F.to_date(F.date_trunc("week", value))
    return F.next_day(F.date_sub(F.to_date(value), 7), week_start)


def period_end(start: Column, grain: str = "week") -> Column:
    """First day after the period (periods are half-open)."""
    return F.add_months(start, 1) if grain == "month" else F.date_add(start, 7)


def period_step(grain: str = "week") -> Column:
    return F.expr("interval 1 month" if grain == "month" else "interval 7 days")
