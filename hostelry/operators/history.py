"""What was known when: the history of rows from successive snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import period_start
from .periods import period_spine


def validity(snapshots: DataFrame, key: str, columns: Sequence[str], taken: str) -> DataFrame:
    """(key, columns, valid_from, valid_to): the intervals in which a row was known with the same values.

    ``snapshots`` stacks the snapshots; ``taken`` is when each was.  A row holds from its snapshot
    until the next one.  Intervals of equal values that touch become one; a snapshot without the
    key ends its interval; ``valid_to`` is null for what the last snapshot still has.  Nulls are
    values like others, rows without a key or a time are left out.  Of rows that repeat a key in a
    snapshot the one of greatest values, in the order of ``columns``, counts.

    One shuffle on the key.  A key's window has one row per snapshot, so it is bounded by their
    number, not by the data.
    """
    state = F.struct(*columns)
    known = snapshots.where(F.col(key).isNotNull() & F.col(taken).isNotNull())
    # One row per snapshot from here to the join, which is bounded by the calendar.
    times = known.select(F.col(taken).alias("_at")).distinct()
    following = times.select("_at", F.lead("_at").over(W.orderBy("_at")).alias("_until"))
    rows = (
        known.repartition(key).groupBy(key, F.col(taken).alias("_at")).agg(F.max(state).alias("_state"))
        .join(F.broadcast(following), "_at")
    )
    by_key = W.partitionBy(key).orderBy("_at")
    goes_on = F.lag("_state").over(by_key).eqNullSafe(F.col("_state")) & F.lag("_until").over(by_key).eqNullSafe(F.col("_at"))
    return (
        rows.withColumn("_begins", (~goes_on).cast("int"))
        .withColumn("_run", F.sum("_begins").over(by_key.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy(key, "_run")
        .agg(
            F.first("_state").alias("_state"), F.min("_at").alias("valid_from"),
            F.max_by("_until", "_at").alias("valid_to"),
        )
        .select(key, *[F.col("_state")[c].alias(c) for c in columns], "valid_from", "valid_to")
    )


def known_per_period(intervals: DataFrame, last: DataFrame, grain: str = "week", week_start: str = "MON") -> DataFrame:
    """(period, known): how many intervals hold at the end of each period, up to the one of ``last``.

    An interval holds at the end of a period if it begins before it and does not stop before
    or at it.  It is counted up in the period in which it begins and down in the one in which it
    stops, and these changes are added up over the calendar: no interval is repeated per
    period and no range join is needed.  ``last`` is a frame of one row and column, a time.
    """
    begin = period_start(F.col("valid_from"), grain, week_start)
    end = period_start(F.col("valid_to"), grain, week_start)
    changes = intervals.select(F.inline(F.array(
        F.struct(begin.alias("period"), F.lit(1).alias("change")),
        F.struct(end.alias("period"), F.lit(-1).alias("change")),
    ))).where("period IS NOT NULL").groupBy("period").agg(F.sum("change").alias("change"))
    ends = last.select(period_start(F.col(last.columns[0]), grain, week_start).alias("last"))
    bounds = changes.agg(F.min("period").alias("first"), F.max("period").alias("newest")).unionByName(
        ends, allowMissingColumns=True
    ).agg(F.min("first").alias("first"), F.greatest(F.max("last"), F.max("newest")).alias("last"))
    so_far = W.orderBy("period").rowsBetween(W.unboundedPreceding, 0)
    return period_spine(bounds, grain).join(F.broadcast(changes), "period", "left").select(
        "period", F.sum(F.coalesce("change", F.lit(0))).over(so_far).alias("known")
    )
