import random
from datetime import date, datetime, timedelta

import pytest
from conftest import collect

from hostelry.operators.history import known_per_period, validity

DAY = datetime(2024, 1, 1)


def at(days):
    return DAY + timedelta(days=days)


def brute_force(snapshots):
    """Walk each key through the sorted snapshot times."""
    times = sorted({t for _, _, t in snapshots})
    out = []
    for key in {k for k, _, _ in snapshots}:
        state = {t: v for k, v, t in snapshots if k == key}
        run = None
        for t in times:
            value = (state[t],) if t in state else None
            if run and run[0] != value:
                out.append((key, run[0][0], run[1], t))
                run = None
            if value is not None and run is None:
                run = (value, t)
        if run:
            out.append((key, run[0][0], run[1], None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_intervals_match_a_walk(rows, seed):
    rng = random.Random(seed)
    data = [(k, rng.choice(["a", "b", None]), at(7 * s)) for s in range(6) for k in range(12) if rng.random() < 0.8]
    got = validity(rows("k long, v string, taken timestamp", *data), "k", ["v"], "taken")
    assert sorted(map(tuple, got.collect()), key=repr) == brute_force(data)


def test_repeated_and_odd_rows(rows):
    df = rows("k long, v int, taken timestamp", (1, 5, at(0)), (1, 7, at(0)), (1, 7, at(9)), (None, 1, at(0)), (2, 1, None))
    assert collect(validity(df, "k", ["v"], "taken")) == [(1, 7, at(0), None)]
    assert validity(df.limit(0), "k", ["v"], "taken").count() == 0


def test_one_shuffle_on_the_key(rows, spark):
    df = rows("k long, v int, taken timestamp", (1, 5, at(0)))
    text = validity(df, "k", ["v"], "taken")._jdf.queryExecution().executedPlan().toString()
    assert text.count("hashpartitioning(k#") == 1


def test_known_at_the_end_of_each_week(rows):
    # 2024-01-01 is a Monday.
    df = rows(
        "k long, valid_from timestamp, valid_to timestamp",
        (1, at(0), at(7)),    # stops as the first week ends: not known at its end any more, by one instant
        (2, at(3), None), (3, at(8), at(10)), (4, at(20), None),
    )
    last = rows("t timestamp", (at(29),))
    got = collect(known_per_period(df, last), "period")
    weeks = [date(2024, 1, 1) + timedelta(days=7 * i) for i in range(5)]
    ends = [at(7 * (i + 1)) for i in range(5)]
    spans = [(r.valid_from, r.valid_to) for r in df.collect()]
    # Known just before the end of the week: begun before it, and not stopped before it.
    expected = [sum(a < e and (b is None or b >= e) for a, b in spans) for e in ends]
    assert got == list(zip(weeks, expected, strict=True))
