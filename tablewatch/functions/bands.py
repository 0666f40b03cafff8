"""Normal band, trend band and their union, from per-series sums.

The trend needs no regression function: for a history indexed 0..n-1 the least-squares line
evaluated at n is ``2 * (3 * sum(i*y) - (n-1) * sum(y)) / (n * (n-1))``, so two plain sums carry it
through partial aggregation and through sliding windows alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .names import _c


@dataclass(frozen=True)
class BandRule:
    """How a band is cut. ``whole`` truncates to integers, otherwise bounds keep two decimals."""

    whole: bool
    clip_always: bool
    floor_lower: bool
    single_upper: float
    k_std: float = 2.5
    k_trend: float = 0.7


# The rules for byte volumes and for profiled metrics.
VOLUME = BandRule(whole=True, clip_always=True, floor_lower=True, single_upper=1.7)
METRIC = BandRule(whole=False, clip_always=False, floor_lower=False, single_upper=2.0)


def history_sums(value: str | Column, index: str | Column, only: Column, over=None) -> list[Column]:
    """Aggregates a band is computed from; ``only`` picks the history rows."""
    y = F.when(only, _c(value).cast("double"))
    iy = F.when(only, _c(index).cast("double") * _c(value).cast("double"))
    made = {
        "n": F.count(y),
        "sum_y": F.sum(y),
        "sum_iy": F.sum(iy),
        "sd": F.stddev_samp(y),
        "min_y": F.min(y),
    }
    return [(c if over is None else c.over(over)).alias(k) for k, c in made.items()]


def _clip(x: Column, rule: BandRule) -> Column:
    bad = F.isnan(x)
    low = x <= 0
    if not rule.clip_always:
        low = low & (F.col("min_y") >= 0)
    return F.when(bad | low, F.lit(0.0)).otherwise(x)


def _shape(x: Column, rule: BandRule) -> Column:
    x = _clip(x, rule)
    return x.cast("long").cast("double") if rule.whole else F.round(x, 2)


def _single(factor: float, rule: BandRule) -> Column:
    x = F.col("sum_y") * F.lit(factor)
    return x if rule.whole else F.round(x, 2)


def add_bands(df: DataFrame, rule: BandRule) -> DataFrame:
    """From the columns of :func:`history_sums` add both bands, their union and its centre."""
    n = F.col("n").cast("double")
    total, weighted = F.col("sum_y"), F.col("sum_iy")
    mean = total / n
    ahead = (F.lit(2.0) * (F.lit(3.0) * weighted - (n - 1) * total)) / (n * (n - 1))
    spread = F.col("sd") * F.lit(rule.k_std)
    up, down = 1.3 + rule.k_trend, 1 - rule.k_trend

    def cases(many: Column, one: Column) -> Column:
        return F.when(F.col("n") > 1, many).when(F.col("n") == 1, one).otherwise(F.lit(0.0))

    many = F.col("n") > 1
    df = df.withColumns({"_mean": F.when(many, mean), "_ahead": F.when(many, ahead), "_spread": spread})
    df = df.withColumns(
        {
            "std_hi": cases(_shape(F.col("_mean") + F.col("_spread"), rule), _single(rule.single_upper, rule)),
            "std_lo": cases(_shape(F.col("_mean") - F.col("_spread"), rule), _single(0.3, rule)),
            "trend_hi": cases(_shape(F.col("_ahead") * F.lit(up), rule), _single(up, rule)),
            "trend_lo": cases(_shape(F.col("_ahead") * F.lit(down), rule), _single(down, rule)),
        }
    )
    lower = F.least("std_lo", "trend_lo")
    if rule.floor_lower:
        lower = F.greatest(lower, F.lit(0.0))
    df = df.withColumns({"band_hi": F.greatest("std_hi", "trend_hi"), "band_lo": lower})
    return df.withColumn("centre", centre("band_lo", "band_hi", rule)).drop("_mean", "_ahead", "_spread")


def centre(low: str | Column, high: str | Column, rule: BandRule) -> Column:
    """Middle of a band; whole-number bands divide as integers."""
    mid = (_c(low) + _c(high)) / 2
    return F.when(F.col("n") > 1, F.floor(mid).cast("double")).otherwise(mid) if rule.whole else mid


def rolling_sums(df: DataFrame, keys: list[str], value: str, days: int, day: str = "day") -> DataFrame:
    """History sums of the preceding ``days`` calendar days, for every row at once.

    Input holds one row per key and day, so a window group is as long as the calendar. The index
    is global to the key; shifting by its minimum in the frame makes it local.
    """
    date_no = F.unix_date(_c(day))
    series = Window.partitionBy(*keys).orderBy(date_no)
    frame = series.rangeBetween(-days, -1)
    df = df.withColumn("_i", F.row_number().over(series).cast("double"))
    y = _c(value).cast("double")
    out = df.select(
        *[c for c in df.columns if c != "_i"],
        F.count(y).over(frame).alias("n"),
        F.sum(y).over(frame).alias("sum_y"),
        F.sum(F.col("_i") * y).over(frame).alias("_iy"),
        F.min(F.when(y.isNotNull(), F.col("_i"))).over(frame).alias("_i0"),
        F.stddev_samp(y).over(frame).alias("sd"),
        F.min(y).over(frame).alias("min_y"),
    )
    return out.withColumn("sum_iy", F.col("_iy") - F.col("_i0") * F.col("sum_y")).drop("_iy", "_i0")
