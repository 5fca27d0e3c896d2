"""All declared constraints of several tables from one scan of each.

Every row is turned into the few entries that it contributes: one for the row itself, one for each broken
column check, one per key that it has and one per key that it refers to.  The entries of all tables are
stacked and counted per (constraint, key): the map-side aggregate folds the entries without a key, and those
of a popular key, into one row per task, and one shuffle brings a key's holders and referrers
together.  So a table that is checked and also referred to is not read again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import Table


@dataclass(frozen=True)
class Constraint:
    """One line of the report."""

    table: str
    check: str
    column: str


_ENTRY = "struct<constraint:int,key:string,own:bigint,other:bigint>"


def _entry(number: int, key: Column | None = None, referred: bool = False) -> Column:
    """A count for the constraint: of the table's own rows, or of rows that others may refer to."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    text = F.lit(None).cast("string") if key is None else key
    return F.struct(F.lit(number), text, zero if referred else one, one if referred else zero).cast(_ENTRY)


def _text_key(keys: Sequence[str]) -> Column:
    """A key as text: of several columns an array with nulls in their places, of one its value."""
    parts = [F.col(k).cast("string") for k in keys]
    return parts[0] if len(parts) == 1 else F.to_json(F.array(*parts), {"ignoreNullFields": "false"})


def _constraints(frames: Mapping[str, DataFrame], tables: Mapping[str, Table]) -> list[Constraint]:
    out = []
    for name in frames:
        table = tables[name]
        out += [Constraint(name, "not_null", c) for c in table.required]
        out += [Constraint(name, "max_length", c) for c in table.text_limits]
        out.append(Constraint(name, "primary_key", ",".join(table.key)))
        out += [Constraint(name, "unique", c) for c in table.unique]
        out += [Constraint(name, "foreign_key", c) for c, (parent, _) in table.parents.items() if parent in frames]
    return out


def _entries_of(
    name: str, frames: Mapping[str, DataFrame], tables: Mapping[str, Table], numbers: Mapping[Constraint, int], rows: int
) -> DataFrame:
    """The entries of one table; ``rows`` is the number under which its rows are counted."""
    df, table = frames[name], tables[name]
    entries = [_entry(rows)]
    for c in table.required:
        entries.append(F.when(F.col(c).isNull(), _entry(numbers[Constraint(name, "not_null", c)])))
    for c, limit in table.text_limits.items():
        entries.append(F.when(F.octet_length(c) > limit, _entry(numbers[Constraint(name, "max_length", c)])))
    key = ",".join(table.key)
    entries.append(_entry(numbers[Constraint(name, "primary_key", key)], _text_key(table.key)))
    for c in table.unique:
        entries.append(F.when(F.col(c).isNotNull(), _entry(numbers[Constraint(name, "unique", c)], F.col(c).cast("string"))))
    for c, (parent, parent_key) in table.parents.items():
        if parent in frames:
            # In the parent's type, so that equal keys of different types have equal texts.
            refers = F.col(c).cast(frames[parent].schema[parent_key].dataType).cast("string")
            entries.append(F.when(F.col(c).isNotNull(), _entry(numbers[Constraint(name, "foreign_key", c)], refers)))
    for child in frames:
        for c, (parent, parent_key) in tables[child].parents.items():
            if parent == name:
                here = F.col(parent_key)
                number = numbers[Constraint(child, "foreign_key", c)]
                entries.append(F.when(here.isNotNull(), _entry(number, here.cast("string"), referred=True)))
    return df.select(F.inline(F.array_compact(F.array(*entries))))


def census(frames: Mapping[str, DataFrame], tables: Mapping[str, Table]) -> DataFrame:
    """(table, check, column, violations, rows) of every declared constraint, as the single checks count them.

    Primary key: rows beyond the first of each key, null being a key.  Unique: the same without nulls.  Foreign key:
    rows whose key no row of the parent has; constraints to tables that are not given are left out.  Empty
    tables have a line per constraint with zeros.
    """
    spark = next(iter(frames.values())).sparkSession
    constraints = _constraints(frames, tables)
    numbers = {c: i for i, c in enumerate(constraints)}
    counted = {name: len(constraints) + i for i, name in enumerate(frames)}
    parts = [_entries_of(name, frames, tables, numbers, counted[name]) for name in frames]
    per_key = reduce(DataFrame.unionAll, parts).groupBy("constraint", "key").agg(
        F.sum("own").alias("own"), F.sum("other").alias("other")
    )
    kinds = {check: [i for c, i in numbers.items() if c.check == check] for check in ("primary_key", "unique", "foreign_key")}
    number, own = F.col("constraint"), F.col("own")
    broken = (
        F.when(number.isin(kinds["primary_key"] + kinds["unique"]), own - 1)
        .when(number.isin(kinds["foreign_key"]), F.when(F.col("other") == 0, own).otherwise(0))
        .otherwise(own)
    )
    found = per_key.groupBy("constraint").agg(F.sum(broken).alias("violations"))
    sizes = found.select(number.alias("_counted"), F.col("violations").alias("_rows"))
    listed = _listed(spark, constraints, counted)
    # One row per constraint on both sides.
    return (
        listed.join(F.broadcast(found), "constraint", "left").join(F.broadcast(sizes), "_counted", "left")
        .select("table", "check", "column", F.coalesce("violations", F.lit(0)).cast("long").alias("violations"),
                F.coalesce("_rows", F.lit(0)).cast("long").alias("rows"))
    )


def _listed(spark: SparkSession, constraints: Sequence[Constraint], counted: Mapping[str, int]) -> DataFrame:
    lines = [
        F.struct(F.lit(c.table).alias("table"), F.lit(c.check).alias("check"), F.lit(c.column).alias("column"),
                 F.lit(i).alias("constraint"), F.lit(counted[c.table]).alias("_counted"))
        for i, c in enumerate(constraints)
    ]
    return spark.range(1).select(F.inline(F.array(*lines)))
