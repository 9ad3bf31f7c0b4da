"""Aligned series sets against a plain walk over each series."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logweave.operators import timeseries as T

START = datetime(2024, 1, 1)


def walk(obs, n, at):
    """{key: (filled, rates, dw)} by going along every series; ``obs`` is (key, position or None, value)."""
    out = {}
    for key in {k for k, _, _ in obs if k is not None}:
        known = {}
        for k, i, v in obs:
            if k == key and i is not None and 0 <= i < n and v is not None:
                known[i] = max(v, known.get(i, v))
        filled, places = [], sorted(known)
        for i in range(n):
            before, after = [p for p in places if p <= i], [p for p in places if p >= i]
            if i in known:
                filled.append(known[i])
            elif before and after:
                a, b = before[-1], after[0]
                filled.append(known[a] + (known[b] - known[a]) * ((at(i) - at(a)) / (at(b) - at(a))))
            else:
                filled.append(None)
        rates = [None if a is None or b is None or a == 0 else b / a - 1 for a, b in zip(filled, filled[1:])]
        den = sum(r * r for r in rates if r is not None)
        num = sum((b - a) ** 2 for a, b in zip(rates, rates[1:]) if a is not None and b is not None)
        out[key] = (filled, rates, num / den if den else None)
    return out


def close(a, b):
    return a is None and b is None or a is not None and b is not None and abs(a - b) <= 1e-9 * max(1, abs(a), abs(b))


CASES = {
    "hour": (lambda i: START + timedelta(hours=i), "1 hour", 60),
    "month": (lambda i: datetime(2024 + i // 12, 1 + i % 12, 1), "1 month", 30),
    "business": (lambda i: START + timedelta(days=i + 2 * (i // 5)), "business day", 40),
    "two weeks": (lambda i: START + timedelta(days=14 * i), "2 weeks", 25),
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("size", [1, 2, 7, 4096])
def test_against_a_walk(spark, case, size):
    at, step, n = CASES[case]
    rng = random.Random(f"{case}{size}")
    obs = []
    for key, share in (("dense", .9), ("half", .5), ("sparse", .06), ("late", .3), (None, .5)):
        for i in range(n):
            if rng.random() < share and (key != "late" or i > n // 2):
                obs.append((key, i, rng.choice([None, 0.0, 1.0, rng.uniform(1, 9)])))
                if rng.random() < .2:
                    obs.append((key, i, rng.uniform(1, 9)))
    obs += [("one", n // 2, 3.0), ("off", None, 5.0), ("half", None, 99.0), ("ends", 0, 2.0), ("ends", n - 1, 5.0), ("outside", n + 3, 1.0)]
    rows = [(k, at(i) if i is not None else at(3) + timedelta(minutes=7), v) for k, i, v in obs]
    df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, value double").repartition(5)
    s = T.align_series(df, at(0), at(n - 1), step, size=size)
    assert s.n == n
    seconds = lambda i: (at(i) - START).total_seconds()
    want = walk(obs, n, seconds)
    filled = {(r.key, r.ts): r.value for r in s.fill().collect()}
    assert len(filled) == n * len(want) and all(close(filled[k, at(i)], want[k][0][i]) for k in want for i in range(n))
    rates = {(r.key, r.ts): r.rate for r in s.return_rates().collect()}
    assert len(rates) == (n - 1) * len(want) and all(close(rates[k, at(i + 1)], want[k][1][i]) for k in want for i in range(n - 1))
    got = {r.key: r.dw for r in s.durbin_watson().collect()}
    assert set(got) == set(want) and all(close(got[k], want[k][2]) for k in want), (got, {k: v[2] for k, v in want.items()})


def test_empty_and_unbounded(spark):
    none = spark.createDataFrame([], "key string, ts timestamp_ntz, value double")
    for s in (T.align_series(none, START, START, "1 day"), T.align_series(none, None, None, "1 day")):
        assert s.fill().collect() == s.return_rates().collect() == s.durbin_watson().collect() == []


def test_positions_reverse_instants(spark):
    for at, step, n in CASES.values():
        rows = spark.range(n).select("id", T.position_of(START, step, T.instant_at(START, step, F.col("id"))).alias("p"),
                                     T.position_of(START, step, T.instant_at(START, step, F.col("id")) + F.expr("interval 1 minute")).alias("off"))
        assert all(r.p == r.id and r.off is None for r in rows.collect())


def test_the_statistic_takes_three_shuffles(spark):
    rows = [("k", START + timedelta(hours=i), float(i % 7 + 1)) for i in range(200)]
    df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, value double")
    dw = T.align_series(df, START, rows[-1][1], "1 hour").durbin_watson()
    plan = dw._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("Exchange hashpartitioning", plan)) == 3
