"""Aggregate expressions shared by the plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import money, percent_change


def money_sum(value: Column) -> Column:
    return F.sum(money(value)).cast("double")


def money_avg(value: Column) -> Column:
    """Mean of the non-missing amounts; null when there are none."""
    return F.try_divide(money_sum(value), F.count(money(value)))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def pearson(x: Column, y: Column) -> Column:
    """Correlation over complete pairs; null without variance.

    Written with ``try_divide`` because the built-in aggregate raises on a
    constant column under ANSI mode.
    """
    complete = x.isNotNull() & y.isNotNull()
    px = F.when(complete, x.cast("double"))
    py = F.when(complete, y.cast("double"))
    return F.try_divide(F.covar_pop(px, py), F.stddev_pop(px) * F.stddev_pop(py))


def trend_columns(value: Column, at: Column) -> dict[str, Column]:
    """Mean, extremes and first-to-last change of a series ordered by ``at``."""
    first, last = F.min_by(value, at), F.max_by(value, at)
    return {
        "avg_value": F.avg(value),
        "max_value": F.max(value),
        "min_value": F.min(value),
        "first_value": first,
        "last_value": last,
        "trend": last - first,
        "trend_pct": percent_change(last - first, first),
    }
