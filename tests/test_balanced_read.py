import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hostelry.sources import jdbc


def counter(values, asked):
    def count(lo, hi, cells):
        asked.append((lo, hi, cells))
        return list(Counter((v - lo) * cells // (hi - lo) for v in values if lo <= v < hi).items())
    return count


def ids(kind):
    rng = random.Random(5)
    if kind == "even":
        return list(range(1, 20001))
    if kind == "dense end":  # old ids sparse over a long range, new ones dense
        return [i * 10**9 for i in range(2000)] + [2 * 10**12 + i for i in range(18000)]
    if kind == "negative":
        return [-rng.randrange(10**6) for _ in range(9000)]
    return [7] * 5000 + [rng.randrange(10**12) for _ in range(5000)]  # one value holds half


@pytest.mark.parametrize("kind", ["even", "dense end", "negative", "hot value"])
@pytest.mark.parametrize("partitions", [2, 16])
def test_ranges_cover_once_and_are_even(spark, kind, partitions):
    values, asked = ids(kind), []
    cuts = jdbc.balanced_cuts(counter(values, asked), min(values), max(values), partitions, cells=64)
    assert cuts == sorted(set(cuts)) and len(cuts) < partitions
    predicates = jdbc.range_predicates("id", cuts)
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 9, "id long")
    met = [F.expr(f"int(coalesce({p}, false))") for p in predicates]
    sizes = df.agg(F.min(sum(met, F.lit(0))).alias("least"), F.max(sum(met, F.lit(0))).alias("most"),
                   *[F.sum(m).alias(f"n{i}") for i, m in enumerate(met)]).first()
    assert (sizes.least, sizes.most) == (1, 1)
    single = max(Counter(values).values())
    assert max(sizes[2:]) <= max(1.6 * len(values) / partitions, single + 0.6 * len(values) / partitions) + 9
    # A level asks for heavy cells only.
    assert len(asked) <= 1 + 4 * partitions * 8


def test_statements_agree_with_the_grid(spark):
    values = ids("dense end")
    spark.createDataFrame([(v,) for v in values], "id long").createOrReplaceTempView("keyed")
    lo, hi = min(values), max(values) + 1
    got = {int(r.cell): r.n for r in spark.sql(jdbc.cells_query("keyed", "id", lo, hi, 64)).collect()}
    assert sum(got.values()) == len(values) and got == dict(counter(values, [])(lo, hi, 64))


def test_nothing_to_cut():
    assert jdbc.balanced_cuts(lambda *a: [], 5, 5, 8) == [] and jdbc.range_predicates("id", []) == ["1 = 1"]
    assert jdbc.range_predicates("id", [9]) == ["id < 9 OR id IS NULL", "id >= 9"]
    assert jdbc.balanced_cuts(lambda *a: [], 1, 9, 8) == []
