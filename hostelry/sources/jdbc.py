"""Relational sources and sinks through Spark's JDBC connector.

Connection details come from the caller; there are no default credentials.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Bounds:
    """Stride of a parallel read over a numeric or date column."""

    column: str
    lower: int | str
    upper: int | str
    partitions: int


def read_options(
    url: str, options: dict[str, str], table: str | None = None,
    query: str | None = None, bounds: Bounds | None = None,
) -> dict[str, str]:
    """Options of a read; a table may be read in parallel, a query may not."""
    if (table is None) == (query is None):
        raise ValueError("name either a table or a query")
    if query is not None and bounds is not None:
        raise ValueError("a parallel read needs a table")
    out = {"fetchsize": "10000", **options, "url": url}
    if query is not None:
        out["query"] = query
    else:
        out["dbtable"] = table
    if bounds is not None:
        out.update(
            partitionColumn=bounds.column, lowerBound=str(bounds.lower),
            upperBound=str(bounds.upper), numPartitions=str(bounds.partitions),
        )
    return out


def read_jdbc(
    spark: SparkSession, url: str, table: str, options: dict[str, str],
    bounds: Bounds | None = None,
) -> DataFrame:
    """Table scan, split on ``bounds`` so that many connections share the work."""
    return spark.read.format("jdbc").options(**read_options(url, options, table, bounds=bounds)).load()


def read_query(spark: SparkSession, url: str, query: str, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(url, options, query=query)).load()


def bounds_query(table: str, column: str) -> str:
    return f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"


def find_bounds(
    spark: SparkSession, url: str, table: str, options: dict[str, str],
    column: str = "id", partitions: int = 64,
) -> Bounds | None:
    """Stride from the column's extremes, asked of the database; None when empty."""
    row = read_query(spark, url, bounds_query(table, column), options).first()
    lo, hi = row[0], row[1]
    return None if lo is None else Bounds(column, lo, hi, partitions)


def cells_query(table: str, column: str, lower: int, upper: int, cells: int) -> str:
    """Rows per cell of an even grid over [lower, upper): at most ``cells`` rows come back."""
    cell = f"FLOOR(({column} - {lower}) * {cells} / {upper - lower})"
    return (
        f"SELECT {cell} AS cell, COUNT(*) AS n FROM {table} "
        f"WHERE {column} >= {lower} AND {column} < {upper} GROUP BY {cell}"
    )


def balanced_cuts(
    count: Callable[[int, int, int], Iterable[tuple[int, int]]], lower: int, upper: int, partitions: int, cells: int = 1024
) -> list[int]:
    """Whole numbers that cut [lower, upper] into about ``partitions`` ranges of equal numbers of rows.

    ``count(lo, hi, cells)`` gives the rows per cell of a grid over [lo, hi).  A cell that holds more than a
    quarter of a range's rows is counted again on a grid of its own, until such cells are single
    values: an even stride would give dense stretches of ids to one connection.  Fewer than
    4 x partitions cells are so heavy at each level, and each level is ``cells`` times finer.
    A value that fills several ranges by itself is one range, as a column cannot split it.
    """
    if partitions < 2 or upper <= lower:
        return []
    total, share, todo, found = None, 0.0, [(lower, upper + 1)], []
    while todo:
        lo, hi = todo.pop()
        grid = min(cells, hi - lo)
        edge = lambda i, lo=lo, hi=hi, grid=grid: lo + -(-(i * (hi - lo)) // grid)
        counted = [(edge(int(c)), edge(int(c) + 1), int(n)) for c, n in count(lo, hi, grid) if n]
        if total is None:
            total = sum(n for _, _, n in counted)
            share = total / partitions
        for start, end, n in counted:
            if n > share / 4 and end - start > 1:
                todo.append((start, end))
            else:
                found.append((start, end, n))
    cuts, before = [], 0
    for start, _, n in sorted(found):
        # The next range begins at the cell whose middle lies beyond the end of the present part.
        part = int((before + n / 2) / share)
        if before and part > (cuts[-1][1] if cuts else 0):
            cuts.append((start, part))
        before += n
    return [start for start, _ in cuts]


def range_predicates(column: str, cuts: Sequence[int]) -> list[str]:
    """One condition per connection: every row meets exactly one, rows without a key the first."""
    if not cuts:
        return ["1 = 1"]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *middle, f"{column} >= {cuts[-1]}"]


def read_balanced(
    spark: SparkSession, url: str, table: str, options: dict[str, str], column: str = "id", partitions: int = 64
) -> DataFrame:
    """Table scan over ranges of a whole-number key that hold about equal numbers of rows, however its values lie."""
    bounds = find_bounds(spark, url, table, options, column, partitions)

    def count(lo: int, hi: int, cells: int) -> list[tuple[int, int]]:
        return [(r[0], r[1]) for r in read_query(spark, url, cells_query(table, column, lo, hi, cells), options).collect()]

    cuts = balanced_cuts(count, int(bounds.lower), int(bounds.upper), partitions) if bounds else []
    properties = {k: v for k, v in read_options(url, options, table).items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(url, table, predicates=range_predicates(column, cuts), properties=properties)


def write_options(
    url: str, table: str, options: dict[str, str], connections: int = 16
) -> dict[str, str]:
    """Options of a full refresh: truncate keeps the table's declared types."""
    return {
        "batchsize": "10000", "numPartitions": str(connections), **options,
        "url": url, "dbtable": table, "truncate": "true",
    }


def refresh_jdbc(
    df: DataFrame, url: str, table: str, options: dict[str, str], connections: int = 16
) -> None:
    """Truncate and insert."""
    chosen = write_options(url, table, options, connections)
    df.write.format("jdbc").mode("overwrite").options(**chosen).save()
