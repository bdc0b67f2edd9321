"""Array builders against plain Python / NumPy on random and edge inputs."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from stationcast.functions import arrays as A


def _py_clean(a):
    """The cleaning rule written directly: strict inliers of (mean - std, mean + std), others -> median."""
    if len(a) == 0 or any(x is None for x in a):
        return None
    mu, sd = np.mean(a), np.std(a)
    inl = [x for x in a if mu - sd < x < mu + sd]
    if not inl:
        return None
    med = float(np.median(inl))
    return [float(x) if mu - sd < x < mu + sd else med for x in a]


def test_py_slice_matches_python(spark):
    rnd = random.Random(1)
    cases = []
    for _ in range(300):
        n = rnd.randint(0, 12)
        a = list(range(n))
        lo = rnd.choice([None, rnd.randint(-15, 15)])
        hi = rnd.choice([None, rnd.randint(-15, 15)])
        cases.append((a, lo, hi))
    df = spark.createDataFrame([(i, a, lo, hi) for i, (a, lo, hi) in enumerate(cases)],
                               "i int, a array<bigint>, lo int, hi int")
    got = {}
    for r in df.select("i", A.py_slice(F.col("a"), F.coalesce("lo", F.lit(0)), F.coalesce("hi", F.size("a")))
                       .alias("s")).collect():
        got[r.i] = r.s
    for i, (a, lo, hi) in enumerate(cases):
        assert got[i] == a[(lo or 0):(len(a) if hi is None else hi)], (a, lo, hi)


def test_py_slice_open_ends(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5],)], "a array<bigint>")
    r = df.select(A.py_slice(F.col("a"), -2).alias("x"), A.py_slice(F.col("a"), None, -3).alias("y")).first()
    assert r.x == [4, 5] and r.y == [1, 2]


def test_pad_and_trailing_sum(spark):
    df = spark.createDataFrame([([1, 2, 3],)], "a array<bigint>")
    r = df.select(A.pad_to(F.col("a"), 5).alias("p"), A.pad_to(F.col("a"), 2).alias("q"),
                  A.trailing_sum(F.col("a"), 2).alias("t")).first()
    assert r.p == [1, 2, 3, 0, 0] and r.q == [1, 2, 3] and r.t == 5


def test_clean_values_matches_numpy(spark):
    rnd = random.Random(7)
    cases = [[0] * 30, [5] * 30, [0] * 29 + [30], [0] * 15 + [2] * 15, [], [1, None, 2], [3], [1, 2]]
    for _ in range(300):
        n = rnd.randint(1, 30)
        scale = rnd.choice([1, 3, 50, 1000])
        cases.append([rnd.randint(0, scale) for _ in range(n)])
    df = spark.createDataFrame([(i, a) for i, a in enumerate(cases)], "i int, a array<bigint>")
    got = {r.i: r.c for r in df.select("i", A.clean_values(F.col("a")).alias("c")).collect()}
    for i, a in enumerate(cases):
        want = _py_clean(a)
        if want is None:
            assert got[i] is None, a
        else:
            assert got[i] == want, a


def test_fixture_windows(spark):
    df = spark.createDataFrame([([0] * 29 + [30],), ([0] * 15 + [2] * 15,)], "a array<bigint>")
    r = df.select(A.clean_values(F.col("a")).alias("c")).collect()
    assert r[0].c == [0.0] * 30          # mean 1, std 5.39: 30 is replaced by the median 0
    assert r[1].c is None                # mean 1, std 1: no strict inlier -> fallback


def test_clean_window_negative_end_fails(spark):
    df = spark.createDataFrame([(list(range(1, 40)),)], "a array<bigint>")
    r = df.select(A.clean_window(F.col("a"), F.lit(-1), F.lit(29)).alias("x"),
                  A.clean_window(F.col("a"), F.lit(50), F.lit(80)).alias("y")).first()
    assert r.x is None and r.y is None


def test_rolling_week_sums_match_python(spark):
    rnd = random.Random(3)
    cases = [[rnd.randint(0, 9) for _ in range(rnd.randint(0, 40))] for _ in range(200)]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(cases)], "i int, a array<bigint>")
    got = {r.i: r.s for r in df.select("i", A.rolling_week_sums(F.col("a"), -10).alias("s")).collect()}
    for i, a in enumerate(cases):
        t = a[:-10]
        want = list(reversed([sum(t[-k - 7:-k]) for k in range(1, 10)]))
        assert got[i] == want, a


def test_scale_crossmean_closed_form(spark):
    rnd = random.Random(11)
    cases = [([rnd.randint(0, 9) for _ in range(rnd.randint(1, 12))],
              [rnd.randint(-1, 9) for _ in range(rnd.randint(1, 12))]) for _ in range(200)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(cases)], "i int, x array<bigint>, y array<bigint>")
    got = {r.i: r.v for r in df.select("i", A.scale_crossmean(F.col("x"), F.col("y")).alias("v")).collect()}
    for i, (x, y) in enumerate(cases):
        want = float(np.mean([a / float(b) if b > 0 else 1 for a in x for b in y]))
        assert abs(got[i] - want) < 1e-12 * max(1.0, abs(want)), (x, y)
