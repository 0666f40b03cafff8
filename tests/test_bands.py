import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tablewatch.functions.bands import METRIC, VOLUME, add_bands, history_sums, rolling_sums


def expected(y, rule):
    """Mean, deviation and least squares done the long way."""
    n = len(y)
    if n == 0:
        return 0, 0, 0, 0
    if n == 1:
        out = (y[0] * rule.single_upper, y[0] * 0.3, y[0] * 2.0, y[0] * 0.3)
        return out if rule.whole else tuple(round(v, 2) for v in out)
    mean, sd = statistics.fmean(y), statistics.stdev(y)
    xm = (n - 1) / 2
    slope = sum((i - xm) * v for i, v in enumerate(y)) / sum((i - xm) ** 2 for i in range(n))
    ahead = mean + slope * (n - xm)
    raw = (mean + 2.5 * sd, mean - 2.5 * sd, ahead * 2.0, ahead * (1 - 0.7))
    clip = rule.clip_always or min(y) >= 0
    raw = [0 if clip and v <= 0 else v for v in raw]
    return [math.trunc(v) if rule.whole else round(v, 2) for v in raw]


def bands_of(spark, series, rule):
    rows = [(k, i, float(v)) for k, y in series.items() for i, v in enumerate(y)]
    df = spark.createDataFrame(rows, "k string, i int, v double")
    out = add_bands(df.groupBy("k").agg(*history_sums("v", "i", F.lit(True))), rule)
    return {r.k: r for r in out.collect()}


@pytest.mark.parametrize("rule", [VOLUME, METRIC])
def test_random_series(spark, rule):
    rng = random.Random(3)
    series = {f"s{j}": [rng.randint(0, 10**6) for _ in range(rng.randint(1, 45))] for j in range(60)}
    series |= {f"neg{j}": [rng.randint(-500, 300) for _ in range(12)] for j in range(10)}
    got = bands_of(spark, series, rule)
    for k, y in series.items():
        r = got[k]
        want = expected(y, rule)
        tolerance = 1.01 if rule.whole else 0.011
        for a, b in zip((r.std_hi, r.std_lo, r.trend_hi, r.trend_lo), want):
            assert abs(a - b) <= tolerance, (k, y, r, want)
        lower = min(r.std_lo, r.trend_lo)
        assert r.band_lo == (max(lower, 0) if rule.whole else lower)
        assert r.band_hi == max(r.std_hi, r.trend_hi)


def test_edges(spark):
    got = bands_of(spark, {"one": [10], "flat": [10, 10], "fall": [30, 20, 10]}, VOLUME)
    assert (got["one"].std_lo, got["one"].std_hi) == (3.0, 17.0)
    assert (got["flat"].std_lo, got["flat"].std_hi) == (10.0, 10.0)
    assert (got["fall"].trend_lo, got["fall"].trend_hi) == (0.0, 0.0)
    assert got["flat"].centre == 11.0  # (3 + 20) // 2
    got = bands_of(spark, {"one": [10], "neg": [-1, -2, -3]}, METRIC)
    assert (got["one"].std_lo, got["one"].std_hi) == (3.0, 20.0)
    neg = got["neg"]
    assert (neg.trend_hi, neg.trend_lo) == (-8.0, -1.2)
    assert neg.band_lo == min(neg.std_lo, -1.2) and neg.band_hi == max(neg.std_hi, -8.0)


def test_order_only_moves_the_trend(spark):
    y = [5, 9, 1, 7, 3, 8]
    got = bands_of(spark, {"a": y, "b": sorted(y)}, METRIC)
    assert (got["a"].std_lo, got["a"].std_hi) == (got["b"].std_lo, got["b"].std_hi)
    assert got["a"].trend_hi != got["b"].trend_hi


def test_rolling_equals_as_of(spark):
    rng = random.Random(5)
    days = sorted(rng.sample(range(60), 40))
    y = {d: rng.randint(0, 1000) for d in days}
    df = spark.createDataFrame([("k", d, float(v)) for d, v in y.items()], "k string, d int, v double")
    df = df.withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")))
    rolled = {r.d: r for r in add_bands(rolling_sums(df, ["k"], "v", 10), METRIC).collect()}
    for d in days:
        past = [y[e] for e in days if d - 10 <= e < d]
        r = rolled[d]
        assert r.n == len(past)
        for a, b in zip((r.std_hi, r.std_lo, r.trend_hi, r.trend_lo), expected(past, METRIC)):
            assert abs(a - b) <= 0.011
