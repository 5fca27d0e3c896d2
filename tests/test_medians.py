import random
import statistics
from datetime import date, timedelta

import pytest

from hostelry.operators.medians import running_median

D0 = date(2024, 1, 1)


def sample(seed, n, draw):
    rng = random.Random(seed)
    return [(D0 + timedelta(days=7 * rng.randrange(20)), draw(rng)) for _ in range(n)]


def expected(data):
    return {
        p: statistics.median(v for q, v in data if q <= p) for p in {q for q, _ in data}
    }


@pytest.mark.parametrize("n, draw", [
    (1, lambda r: 5.0),
    (2, lambda r: float(r.randrange(3))),
    (501, lambda r: round(r.lognormvariate(5, 1), 2)),
    (800, lambda r: 99.0 if r.random() < 0.4 else float(r.randrange(100))),
    (300, lambda r: r.choice([1.0, 1e9 + r.random()])),
    (400, lambda r: -r.random() if r.random() < 0.5 else r.random()),
])
@pytest.mark.parametrize("buckets", [4, 256])
def test_exact(rows, n, draw, buckets):
    data = sample(n, n, draw)
    df = rows("period date, value double", *data, (D0, None), (None, 3.0))
    got = {r.period: r.median for r in running_median(df, buckets).collect()}
    assert got.keys() == expected(data).keys()
    for period, value in expected(data).items():
        assert got[period] == pytest.approx(value, abs=1e-12)


def test_approx_is_within_one_bucket(rows):
    data = sample(2, 2000, lambda r: r.random())
    df = rows("period date, value double", *data)
    for r in running_median(df, 64, approx=True).collect():
        seen = sorted(v for p, v in data if p <= r.period)
        rank = sum(v <= r.median for v in seen) / len(seen)
        assert abs(rank - 0.5) < 0.1


def test_empty(rows):
    df = rows("period date, value double", (D0, None))
    assert running_median(df).count() == 0


@pytest.mark.parametrize("buckets", [4, 256])
def test_weights_count_as_repeats(rows, buckets):
    rng = random.Random(9)
    data = [(p, v, rng.randrange(1, 6)) for p, v in sample(3, 300, lambda r: float(r.randrange(50)))]
    df = rows("period date, value double, n long", *data, (D0, None, 5))
    got = {r.period: r.median for r in running_median(df, buckets, weight="n").collect()}
    assert got == expected([(p, v) for p, v, n in data for _ in range(n)])
