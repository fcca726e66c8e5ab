"""Ordered-per-key helpers against plain Python, with keys of every size, ties, nulls and many ranges."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from marquee.functions.quantiles import exact_percentiles
from marquee.functions.ranking import positions
from marquee.functions.windows import look_back, running_totals


def rows_of(n, seed, keys=(0, 0, 0, 0, 1, 2, None)):
    rng = random.Random(seed)
    keys = [*keys, *range(100, 160)]
    weights = [30] * (len(keys) - 60) + [1] * 60
    return [(rng.choices(keys, weights)[0], i, rng.randint(0, 6), rng.randint(-9, 9)) for i in range(n)]


def grouped(rows):
    order = lambda r: (r[0] is not None, r[0] or 0)
    return [list(g) for _, g in itertools.groupby(sorted(rows, key=lambda r: (order(r), r[1])), key=order)]


@pytest.mark.parametrize("n, ranges", [(0, 4), (1, 4), (600, 1), (600, 7), (90, 80)])
@pytest.mark.parametrize("back", [1, 3, 9])
def test_look_back_equals_the_rows_before(spark, n, ranges, back):
    rows = rows_of(n, n + back)
    df = spark.createDataFrame(rows, "k long, t long, x long, v long")
    got = look_back(df, ["k"], [F.col("t")], F.col("v"), back, ranges=ranges)
    assert got.columns == ["k", "t", "x", "v", "past", "seq"]
    want = [(k, t, x, v, [r[3] for r in g[max(0, i - back):i]], i + 1) for g in grouped(rows) for i, (k, t, x, v) in enumerate(g)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("ranges", [1, 6, 50])
def test_totals_and_positions(spark, ranges):
    rows = rows_of(500, ranges)
    df = spark.createDataFrame(rows, "k long, t long, x long, v long")
    total = {(r.k, r.t): (r.s, r.c) for r in running_totals(df, ["k"], [F.col("t")], {"s": F.col("v"), "c": F.lit(1)}, ranges=ranges).collect()}
    place = {(r.k, r.t): r.p for r in positions(df, ["k"], [F.col("t").desc()], "p", ranges=ranges).collect()}
    for g in grouped(rows):
        sums = list(itertools.accumulate(r[3] for r in g))
        for i, (k, t, _, _) in enumerate(g):
            assert total[k, t] == (sums[i], i + 1) and place[k, t] == len(g) - 1 - i
    whole = sorted((r.p, r.t) for r in positions(df, [], [F.col("t")], "p", ranges=ranges).collect())
    assert whole == [(i, i) for i in range(500)]


def test_equal_rows_are_spread_and_counted(spark):
    df = spark.createDataFrame([(1, 5)] * 400 + [(1, 4), (2, 5)], "k long, t long")
    got = positions(df, ["k"], [F.col("t")], "p", ranges=20)
    assert sorted(r.p for r in got.where("k = 1").collect()) == list(range(401))
    assert [r.p for r in got.where("t = 4 or k = 2").collect()] == [0, 0]


def plain_percentile(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    lo = int(at)
    hi = min(lo + 1, len(values) - 1)
    return round(values[lo] + (values[hi] - values[lo]) * (at - lo), 6)


@pytest.mark.parametrize("ranges", [1, 5, 64])
def test_percentiles_equal_sorted_values(spark, ranges):
    rng = random.Random(ranges)
    rows = [(rng.choice(["a", "a", "a", "b", None]), round(rng.expovariate(0.1), 2)) for _ in range(3000)]
    rows += [("one", 7.5), ("two", 1.0), ("two", 2.0), ("none", None), ("same", 3.0), ("same", 3.0)] + [("wide", float(i) ** 3) for i in range(200)]
    ps = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}
    got = {r.g: r for r in exact_percentiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", ps, ranges=ranges).collect()}
    groups = {g: [v for k, v in rows if k == g and v is not None] for g in {g for g, v in rows if v is not None}}
    assert set(got) == set(groups)
    for g, values in groups.items():
        for name, p in ps.items():
            assert got[g][name] == pytest.approx(plain_percentile(values, p), abs=1e-6), (g, name)
