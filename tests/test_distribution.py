import math
import random

import numpy as np
import pytest
from conftest import collect

from hostelry.operators import distribution


def test_value_counts_share_counts_null_rows(rows):
    df = rows("v int", (2,), (1,), (2,), (None,))
    assert collect(distribution.value_counts(df, "v")) == [(1, 1, 25.0), (2, 2, 50.0)]


@pytest.mark.parametrize("values", [
    [1], [3, 3, 3], [0, 1, 2, 3, 4], [0, 10], [1, 2, 2, 3, 50],
    [random.Random(1).randrange(100) for _ in range(500)],
])
def test_histogram_matches_numpy(rows, values):
    got = collect(distribution.histogram(rows("v int", *[(v,) for v in values], (None,)), "v"), "bin")
    counts, edges = np.histogram(values, bins=10)
    assert [g[0] for g in got] == list(range(1, 11))
    assert [g[3] for g in got] == list(counts)
    assert [g[1] for g in got] == pytest.approx(list(edges[:-1]))
    assert got[-1][2] == pytest.approx(edges[-1])


def test_histogram_of_nothing(rows):
    assert distribution.histogram(rows("v int", (None,)), "v").count() == 0


def test_density_matches_numpy(rows):
    rng = random.Random(4)
    values = np.array([rng.randrange(6) for _ in range(300)], dtype=float)
    got = collect(distribution.gaussian_kde(rows("v double", *[(float(v),) for v in values]), "v"), "point")
    h = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min(), values.max(), 200)
    dens = np.exp(-(((grid[:, None] - values[None, :]) / h) ** 2) / 2).sum(axis=1)
    dens /= len(values) * h * math.sqrt(2 * math.pi)
    assert [g[1] for g in got] == pytest.approx(list(grid))
    assert [g[2] for g in got] == pytest.approx(list(dens))


@pytest.mark.parametrize("values", [[2], [2, 2, 2]])
def test_density_without_spread_is_null(rows, values):
    got = collect(distribution.gaussian_kde(rows("v int", *[(v,) for v in values]), "v"))
    assert {g[2] for g in got} == {None}


def exact_density(values, points=200):
    h = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min(), values.max(), points)
    out = np.zeros(points)
    for part in np.array_split(values, max(1, len(values) // 1000)):
        out += np.exp(-(((grid[:, None] - part[None, :]) / h) ** 2) / 2).sum(axis=1)
    return h, out / (len(values) * h * math.sqrt(2 * math.pi))


@pytest.mark.parametrize("cells", [64, 512, 4096])
def test_binned_density_is_within_its_error(spark, cells):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(1e6, 5, 3000), rng.exponential(9, 2000) + 1e6])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (math.nan,)], "v double")
    got = collect(distribution.binned_density(df, "v", cells=cells), "point")
    h, exact = exact_density(values)
    off = np.abs(np.array([g[2] for g in got]) - exact)
    bound = distribution.binning_error(float(np.ptp(values)), h, cells)
    assert len(got) == 200 and off.max() <= bound + 1e-9


def test_binned_density_of_a_million_values(spark):
    df = spark.range(10**6).selectExpr("pow(id / 1e6, 2) * 100 AS v")
    out = distribution.binned_density(df, "v")
    got = collect(out, "point")
    values = (np.arange(10**6) / 1e6) ** 2 * 100
    h, exact = exact_density(values, 200)
    assert len(got) == 200
    assert np.abs(np.array([g[2] for g in got]) - exact).max() <= distribution.binning_error(float(np.ptp(values)), h)


@pytest.mark.parametrize("values", [[2.0], [2.0, 2.0]])
def test_binned_density_without_spread_is_null(rows, values):
    got = collect(distribution.binned_density(rows("v double", *[(v,) for v in values]), "v"))
    assert {g[2] for g in got} == {None}


def test_binned_density_of_nothing(rows):
    assert distribution.binned_density(rows("v double", (None,)), "v").count() == 0


def test_density_of_large_values_keeps_its_spread(rows):
    values = np.array([1e9 + i % 7 for i in range(100)])
    got = collect(distribution.gaussian_kde(rows("v double", *[(float(v),) for v in values]), "v"), "point")
    assert [g[2] for g in got] == pytest.approx(list(exact_density(values)[1]))
