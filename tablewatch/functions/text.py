"""Report texts: byte sizes, numbers, metric labels, bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import _c

# Units of counted numbers and the wording of metric kinds.
HUNDRED_MILLION, TEN_THOUSAND = "亿", "万"
LABELS = {
    "_sum_poly1": "sum",
    "_avg_poly1": "valid mean",
    "_num_poly2": "valid count",
    "_rate_poly2": "valid rate",
    "_num_poly3": "default count",
    "_rate_poly3": "default rate",
}


def fmt_bytes(size: str | Column) -> Column:
    """Table size with two decimals, Tb down to Kb."""
    size = _c(size).cast("double")
    return (
        F.when(size >= 1024.0**4, F.format_string("%.2fTb", size / 1024.0**4))
        .when(size >= 1024.0**3, F.format_string("%.2fGb", size / 1024.0**3))
        .when(size >= 1024.0**2, F.format_string("%.2fMb", size / 1024.0**2))
        .otherwise(F.format_string("%.2fKb", size / 1024.0))
    )


def fmt_file_bytes(size: str | Column) -> Column:
    """Partition size, Gb down to kb, without padding zeros."""
    size = _c(size).cast("double")

    def unit(scale: float, name: str) -> Column:
        return F.concat(F.round(size / scale, 2).cast("string"), F.lit(name))

    return (
        F.when(size >= 1024.0**3, unit(1024.0**3, "Gb"))
        .when(size >= 1024.0**2, unit(1024.0**2, "Mb"))
        .otherwise(unit(1024.0, "kb"))
    )


def fmt_number(value: str | Column, like: str | Column | None = None) -> Column:
    """A number in the unit fitting ``like`` (itself by default); plain numbers drop ``.00``."""
    value = _c(value).cast("double")
    like = value if like is None else _c(like)
    plain = F.regexp_replace(F.format_string("%.2f", value), "\\.00$", "")
    return (
        F.when(like >= 1e8, F.format_string(f"%.2f{HUNDRED_MILLION}", value / 1e8))
        .when(like >= 1e4, F.format_string(f"%.2f{TEN_THOUSAND}", value / 1e4))
        .otherwise(plain)
    )


def fmt_lower(value: str | Column, like: str | Column) -> Column:
    """Lower bounds below one are shown as 0."""
    return F.when(_c(value).cast("long") != 0, fmt_number(value, like)).otherwise("0")


def metric_label(metric: str | Column) -> Column:
    """``price_sum_poly1`` -> ``price (sum)``."""
    metric = _c(metric)
    out = F.when(metric == "row_num", F.lit("row_num (rows)"))
    for suffix, label in LABELS.items():
        out = out.when(
            metric.contains(suffix),
            F.concat(F.replace(metric, F.lit(suffix), F.lit("")), F.lit(f" ({label})")),
        )
    return out.otherwise("unknown")


def ratio_text(value: str | Column, centre: str | Column) -> Column:
    ratio = F.round(F.try_divide(_c(value), _c(centre)), 2)
    return F.when(
        _c(centre) != 0, F.concat(ratio.cast("string"), F.lit(" times the expected value"))
    ).otherwise("history is all zero")


def interval_text(
    metric: str | Column, value: str | Column, low: str | Column, high: str | Column
) -> Column:
    """``v not in [lo,hi]``; rates as percentages."""
    value, low, high = _c(value), _c(low), _c(high)
    rate = F.concat(
        value.cast("string"), F.lit("% not in ["), low.cast("string"), F.lit("%,"),
        high.cast("string"), F.lit("%]"),
    )
    number = F.concat(
        fmt_number(value), F.lit(" not in ["), fmt_lower(low, value), F.lit(","),
        fmt_number(high, value), F.lit("]"),
    )
    return F.when(_c(metric).contains("rate_poly"), rate).otherwise(number)


def first_users(users: str | Column, n: int = 3) -> Column:
    """First names of a comma-separated list, in order."""
    names = F.filter(F.split(_c(users), ","), lambda u: u != "")
    return F.concat_ws(",", F.slice(F.array_sort(names), 1, n))


def sql_tokens(query: str | Column) -> Column:
    """Blank-separated tokens of a lower-cased statement without line comments."""
    text = F.regexp_replace(F.lower(_c(query)), "--.*?\n", " ")
    return F.array_distinct(F.split(F.regexp_replace(text, "(\n|\t)", " "), " "))
