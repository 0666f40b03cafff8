"""Predicates deciding which tables, series and alerts matter. Thresholds are arguments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import _c

MIB = 1024**2
GIB = 1024**3
DAY_SECONDS = 86400

# The metric suffixes and the spelling of retention metrics.
METRIC_SUFFIX = "_sum_poly1|_avg_poly1|_num_poly2|_rate_poly2|_num_poly3|_rate_poly3"
RETENTION_PATTERN = (
    "re[1-9]|re_[1-9]|[1-9]re|rr[1-9]|mr[1-9]|afr[1-9]|nfr[1-9]|retian[1-9]|remain_[1-9]"
)
UNNAMED_PATTERN = "其他|其它|other|unknown"


def as_date(day: str | dt.date | Column) -> Column:
    return day if isinstance(day, Column) else F.lit(day).cast("date")


def midnight(day: str | Column) -> Column:
    """Epoch seconds of the start of a day (UTC)."""
    return F.unix_date(_c(day)).cast("long") * DAY_SECONDS


def epoch_ms_date(ms: str | Column) -> Column:
    return F.timestamp_millis(_c(ms)).cast("date")


def epoch_ms_clock(ms: str | Column) -> Column:
    return F.date_format(F.timestamp_millis(_c(ms)), "HH:mm:ss")


def is_important(
    kind: str | Column = "source_kind",
    queries: str | Column = "queries",
    table_bytes: str | Column = "table_bytes",
    idle_bytes: int = 10 * GIB,
    few_bytes: int = 100 * MIB,
    few_queries: int = 3,
) -> Column:
    """Worth a person's time: the less a table is read, the larger it has to be."""
    kind, queries, size = _c(kind), _c(queries), _c(table_bytes)
    return (
        ((kind == "raw_log") & (queries > 0))
        | ((kind != "raw_log") & (queries == 0) & (size >= idle_bytes))
        | (queries.between(1, few_queries) & (size >= few_bytes))
        | (queries > few_queries)
        | (kind == "shared_event")
    )


def is_fresh(
    updated: str | Column, as_of, max_age: int = 2
) -> Column:
    return F.datediff(as_date(as_of), _c(updated)) <= max_age


def is_warehouse_table(
    db: str | Column,
    table: str | Column,
    schema_pattern: str,
    temp_pattern: str = "temp|tmp",
) -> Column:
    return _c(db).rlike(schema_pattern) & ~_c(table).rlike(temp_pattern)


def run_flag(
    update_clock: str | Column = "update_clock",
    partition_keys: str | Column = "partition_keys",
    before: str = "07:00:00",
) -> Column:
    """``early`` for tables ready before the cut-off time or partitioned by hour, else ``else``."""
    early = (_c(update_clock) < before) | _c(partition_keys).rlike("hour")
    return F.when(early, "early").otherwise("else")


def passes_gate(
    metric: str | Column,
    value: str | Column,
    share: str | Column,
    min_share: float = 3.0,
    min_rate: float = 5.0,
    min_count: float = 1000.0,
) -> Column:
    """Alerts need a visible share, and default-value metrics a visible size."""
    metric, value = _c(metric), _c(value)
    return (
        (_c(share) > min_share)
        & ~(metric.contains("rate_poly3") & (value < min_rate))
        & ~(metric.contains("num_poly3") & (value < min_count))
    )


def is_unnamed(dimension: str | Column, pattern: str = UNNAMED_PATTERN) -> Column:
    return F.lower(_c(dimension)).rlike(pattern)


def is_retention(metric: str | Column, pattern: str = RETENTION_PATTERN) -> Column:
    return _c(metric).rlike(pattern)


def retention_days(metric: str | Column, pattern: str = RETENTION_PATTERN) -> Column:
    """Days a retention metric lags behind, read from its own token; 0 for other metrics."""
    token = F.regexp_extract(_c(metric), f"[0-9]*(?:{pattern})[0-9]*", 0)
    days = F.regexp_extract(token, "([0-9]+)", 1).try_cast("int")
    return F.when(is_retention(metric, pattern), F.coalesce(days, F.lit(0))).otherwise(0)


def base_metric(metric: str | Column) -> Column:
    """Column a metric was computed from."""
    return F.regexp_replace(_c(metric), METRIC_SUFFIX, "")


def age_label(prefix: str, days: Column, shown: Column, oldest: int, strict: bool = False) -> Column:
    """``CutOff3Days`` / ``CutOff100+Days``; ``strict`` puts the limit itself on the near side."""
    old = days > oldest if strict else days >= oldest
    return F.when(old, F.lit(f"{prefix}{oldest}+Days")).otherwise(
        F.concat(F.lit(prefix), shown.cast("string"), F.lit("Days"))
    )


def catalog_status(
    guid: str | Column, table_bytes: str | Column, updated: str | Column, as_of
) -> Column:
    """Status a table has by its catalog record alone. The catalog lags a day, so age starts at 2."""
    age = F.datediff(as_date(as_of), _c(updated))
    stopped = age_label("TaskStop", age, age, 100, strict=True)
    return (
        F.when(F.coalesce(_c(guid), F.lit("")) == "", "NotFound")
        .when(F.coalesce(_c(table_bytes), F.lit(0)) <= 0, "EmptyTable")
        .when(age >= 2, stopped)
        .otherwise("normal")
    )


def is_measured(status: str | Column = "status", oldest: int = 100) -> Column:
    """Tables worth measuring: normal ones and those stopped for less than ``oldest`` days."""
    status = _c(status)
    days = F.regexp_extract(status, "([0-9]+)", 1).try_cast("int")
    return (status == "normal") | (status.contains("TaskStop") & (days < oldest))
