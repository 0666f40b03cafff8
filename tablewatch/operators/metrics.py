"""Profiled metrics against their own history.

A series is (table, dimension, metric). Everything that looks at one (table, dimension) runs on a
single exchange by those two columns: its rows are at most days x metrics, whatever the size of the
profiled table, and every later window and aggregate on finer keys reuses that partitioning. Only the
totals over all dimensions cross it; they are pre-aggregated and joined back with salted keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bands import METRIC, add_bands, history_sums, rolling_sums
from ..functions.rules import (
    RETENTION_PATTERN,
    as_date,
    base_metric,
    is_retention,
    is_unnamed,
    midnight,
    passes_gate,
    retention_days,
)
from ..sources.tables import days_between
from .joins import spread_join, without

GROUP = ["name", "dimension"]
SERIES = ["name", "dimension", "metric"]
ATTRIBUTES = ["app_name", "owner", "table_bytes", "queries", "downstream"]


def share(value: str | Column, total: str | Column) -> Column:
    """Percentage of a total, without sign; 0 when there is no total."""
    value = F.col(value) if isinstance(value, str) else value
    total = F.col(total) if isinstance(total, str) else total
    part = F.abs(F.round(F.try_divide(value * F.lit(100.0), total), 2))
    return F.coalesce(F.when(total != 0, part), F.lit(0.0))


def metric_totals(rows: DataFrame, as_of=None, run: str | None = None) -> DataFrame:
    """Per day, table and metric: the sum over all dimensions, and the table's rows beside it.

    With a run, only tables that have metrics of this run on the as-of day are kept. The sums combine
    on the map side; a window over them is as long as a table has days and metrics.
    """
    here = F.lit(True) if run is None else (F.col("day") == as_date(as_of)) & (F.col("run_flag") == run)
    totals = rows.groupBy("day", "name", "metric").agg(
        F.sum("value").alias("total_value"), F.max(here).alias("_here")
    )
    rows_now = F.when(F.col("metric") == "row_num", F.col("total_value"))
    return (
        totals.repartition("name")
        .withColumns(
            {
                "total_rows": F.max(rows_now).over(Window.partitionBy("name", "day")),
                "_run": F.max("_here").over(Window.partitionBy("name")),
            }
        )
        .where("_run")
        .drop("_here", "_run")
    )


def add_totals(rows: DataFrame, as_of=None, run: str | None = None) -> DataFrame:
    """Totals and row counts beside every metric value, with the shares they give.

    A table with most of the dimensions is a hot key of the join back, so the rows are spread by
    dimension. Tables that are not in the run drop out here.
    """
    keys = ["day", "name", "metric"]
    totals = spread_join(rows, metric_totals(rows, as_of, run), keys, ["dimension"], "inner")
    in_group = Window.partitionBy(*GROUP, "day")
    row_num = F.max(F.when(F.col("metric") == "row_num", F.col("value"))).over(in_group)
    return (
        totals.repartition(*GROUP)
        .withColumn("row_num", row_num)
        .withColumns(
            {"value_share": share("value", "total_value"), "row_share": share("row_num", "total_rows")}
        )
    )


def is_thin(max_rows: float = 1000, row_bytes: float = 100 * 1024) -> Column:
    """Groups with few but very large rows on some day, over a (table, dimension) window."""
    thin = (
        (F.col("metric") == "row_num")
        & (F.try_divide(F.col("day_bytes"), F.col("value")) > row_bytes)
        & (F.col("value") < max_rows)
    )
    return F.coalesce(F.max(thin).over(Window.partitionBy(*GROUP)), F.lit(False))


def day_rank() -> Column:
    """Position of a row's day among the days of its (table, dimension); the last one counts them."""
    return F.dense_rank().over(Window.partitionBy(*GROUP).orderBy("day"))


def drop_whitelisted(rows: DataFrame, whitelist: DataFrame) -> DataFrame:
    """Listed tables, and listed columns in any table, are left out.

    Two equi anti joins; the disjunction in one condition would compare every pair.
    """
    columns = whitelist.select(F.col("column_name").alias("_base"))
    kept = without(rows, whitelist, ["name"]).withColumn("_base", base_metric("metric"))
    return without(kept, columns, ["_base"]).drop("_base")


def metric_history(
    metrics: DataFrame,
    as_of,
    run: str,
    whitelist: DataFrame | None = None,
    days: int = 45,
    min_days: int = 5,
    max_rows: float = 1000,
    row_bytes: float = 100 * 1024,
    deny_dimension: str | None = None,
) -> DataFrame:
    """Metric rows of this run's tables in the window, with totals, shares and exclusions applied.

    Totals count every dimension, excluded ones too; they also tell which tables are in the run, so
    no further lookup is needed.
    """
    day = as_date(as_of)
    rows = days_between(metrics, F.date_sub(day, days), day)
    days_seen = F.max("_rank").over(Window.partitionBy(*GROUP))
    rows = (
        add_totals(rows, as_of, run)
        .withColumn("_rank", day_rank())
        .withColumns({"_thin": is_thin(max_rows, row_bytes), "_days": days_seen})
        .where(~F.col("_thin") & (F.col("_days") >= min_days))
        .drop("_thin", "_days", "_rank")
    )
    if deny_dimension:
        rows = rows.where(~F.lower("dimension").rlike(deny_dimension))
    return rows if whitelist is None else drop_whitelisted(rows, whitelist)


def series_rows(history: DataFrame, as_of, retention: str = RETENTION_PATTERN) -> DataFrame:
    """Rows with their series' own day (retention metrics lag), numbered by day.

    ``is_now`` marks the judged row, ``is_past`` the ones before it. Later rows stay unmarked: they
    come last in the numbering, and a filter on the computed day would only repeat its cost. Null
    values are kept out of the numbering and of the bands.
    """
    series_day = F.date_sub(as_date(as_of), retention_days("metric", retention))
    order = Window.partitionBy(*SERIES).orderBy(F.col("value").isNull(), "day")
    return history.withColumn("series_day", series_day).withColumns(
        {
            "is_now": F.col("day") == F.col("series_day"),
            "is_past": F.col("day") < F.col("series_day"),
            "_i": (F.row_number().over(order) - 1).cast("double"),
        }
    )


def score_series(
    history: DataFrame, as_of, retention: str = RETENTION_PATTERN, gate_share: str = "now"
) -> DataFrame:
    """One row per series: today, band, shares and their medians, and the verdict inputs.

    Today, history, new and missing series come out of this one aggregate. ``gate_share='max'``
    gates by the larger of today's and the usual share, so a series that falls to 0 is still seen.
    ``behind`` keeps the history itself, one entry per day of the window, for :func:`with_evidence`;
    it is pruned from plans that do not ask for it.
    """
    rows = series_rows(history, as_of, retention)
    now, past = F.col("is_now"), F.col("is_past") & F.col("value").isNotNull()
    empty = F.coalesce(F.col("row_num"), F.lit(-1.0)) == 0
    scored = rows.groupBy(*SERIES, "series_day").agg(
        F.max(F.when(now & ~empty, F.col("value"))).alias("value"),
        F.max(F.when(now, F.col("value_share"))).alias("value_share"),
        F.max(F.when(now, F.col("row_share"))).alias("row_share"),
        F.max(F.when(now, F.col("row_num"))).alias("row_num"),
        F.round(F.median(F.when(past, F.col("value_share"))), 2).alias("usual_value_share"),
        F.round(F.median(F.when(past, F.col("row_share"))), 2).alias("usual_row_share"),
        F.max_by("metric_class", "day").alias("metric_class"),
        F.collect_list(F.when(past, F.struct(F.col("day").alias("at_day"), "value"))).alias("behind"),
        F.count_if(F.col("is_now") | F.col("is_past")).alias("_known"),
        *history_sums("value", "_i", past),
    ).where(F.col("_known") > 0).drop("_known")
    seen = F.col("value_share")
    if gate_share == "max":
        seen = F.greatest(seen, F.col("usual_value_share"))
    extra = {"gate_share": seen, "is_retention": is_retention("metric", retention)}
    return add_bands(scored.withColumns(extra), METRIC)


def verdict(min_share: float = 3.0, min_rate: float = 5.0, min_count: float = 1000.0) -> Column:
    """``out_of_band``, ``new`` or ``missing`` for a scored series, else null."""
    gated = passes_gate("metric", "value", "gate_share", min_share, min_rate, min_count)
    off = (F.col("value") < F.col("band_lo")) | (F.col("value") > F.col("band_hi"))
    return (
        F.when(F.col("value").isNotNull() & gated & (F.col("n") > 0) & off, "out_of_band")
        .when(F.col("value").isNotNull() & gated & (F.col("n") == 0) & (F.col("value") != 0), "new")
        .when(
            F.col("value").isNull() & (F.col("n") > 0) & (F.col("centre") != 0) & ~F.col("is_retention"),
            "missing",
        )
    )


def flag_series(scored: DataFrame, min_share: float = 3.0, min_rate: float = 5.0, min_count: float = 1000.0) -> DataFrame:
    """Scored series with a verdict."""
    return scored.withColumn("flag", verdict(min_share, min_rate, min_count)).where(F.col("flag").isNotNull())


def metric_anomalies(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col("flag") == "out_of_band")


def new_series(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col("flag") == "new")


def missing_series(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col("flag") == "missing")


def _own_rows(as_of, days: int = 30) -> Column:
    """Rows a flagged series adds for itself: its value, a zero, or its value after 30 zero days."""
    value = F.struct(F.col("series_day").alias("at_day"), F.col("value").alias("value"))
    zeros = F.transform(
        F.sequence(F.lit(1), F.lit(days)),
        lambda i: F.struct(F.date_sub("series_day", i).alias("at_day"), F.lit(0.0).alias("value")),
    )
    gone = F.struct(as_date(as_of).alias("at_day"), F.lit(0.0).alias("value"))
    return (
        F.when(F.col("flag") == "out_of_band", F.array(value))
        .when(F.col("flag") == "new", F.concat(F.array(value), zeros))
        .otherwise(F.array(gone))
    )


def table_attributes(metrics: DataFrame, as_of) -> DataFrame:
    """One attribute row per table as of the day; combined on the map side."""
    return (
        metrics.where(F.col("day") == as_date(as_of))
        .groupBy("name")
        .agg(F.max(F.struct(*ATTRIBUTES)).alias("_a"))
        .select("name", "_a.*")
    )


def with_evidence(flagged: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Flagged series with the history behind them, new ones with ``days`` zero days instead.

    Both come from the scored row itself, so nothing is joined or computed again.
    """
    rows = F.explode(F.concat(F.col("behind"), _own_rows(as_of, days)))
    return flagged.select(*SERIES, "metric_class", "flag", rows.alias("_r")).select(
        *SERIES, "metric_class", "flag", "_r.at_day", "_r.value"
    )


def anomaly_rows(evidence: DataFrame, metrics: DataFrame, as_of, run: str) -> DataFrame:
    """Rows as stored: attributes and row count of the as-of day, partition columns last.

    Only flagged series get here; both lookups have one row per key.
    """
    day = as_date(as_of)
    counts = (
        metrics.where((F.col("day") == day) & (F.col("metric") == "row_num"))
        .groupBy(F.col("name").alias("_n"), F.col("dimension").alias("_d"))
        .agg(F.max("value").cast("long").alias("row_num"))
    )
    same = evidence["name"].eqNullSafe(counts["_n"]) & evidence["dimension"].eqNullSafe(counts["_d"])
    return (
        evidence.join(counts, same, "left")
        .drop("_n", "_d")
        .join(table_attributes(metrics, as_of), "name", "left")
        .select(
            "app_name", "name", "owner", "table_bytes", "queries", "downstream",
            midnight("at_day").alias("update_time"), "dimension", "metric", "metric_class", "value",
            F.coalesce("row_num", F.lit(0).cast("long")).alias("row_num"), "flag",
            day.alias("day"), F.lit(run).alias("run_flag"),
        )
    )


def missing_new_summary(flagged: DataFrame) -> DataFrame:
    """Which metrics or dimensions a table misses or gained, one row per item.

    Long form: a table can lose any number of dimensions, so they are not gathered into one list.
    """
    whole = F.col("dimension") == ""
    kind = (
        F.when(F.col("flag") == "new", "new_dimension")
        .when(whole, "missing_metrics")
        .when(~is_unnamed("dimension"), "missing_dimension")
    )
    rows = flagged.where(F.col("flag").isin("new", "missing")).withColumn("kind", kind)
    items = F.array(
        F.struct(F.lit("metric").alias("item_type"), base_metric("metric").alias("item")),
        F.struct(F.lit("dimension").alias("item_type"), F.col("dimension").alias("item")),
    )
    return (
        rows.where(F.col("kind").isNotNull())
        .select("name", "kind", F.explode(items).alias("_i"))
        .where((F.col("kind") != "missing_metrics") | (F.col("_i.item_type") == "metric"))
        .select("name", "kind", "_i.item_type", "_i.item")
        .distinct()
    )


def rolling_bands(daily: DataFrame, days: int = 45, keys: list[str] = SERIES) -> DataFrame:
    """Band of every series on every day, from the days before it. One exchange."""
    rows = daily.where(F.col("value").isNotNull())
    return add_bands(rolling_sums(rows, keys, "value", days), METRIC)


def rolling_anomalies(daily: DataFrame, days: int = 45, keys: list[str] = SERIES) -> DataFrame:
    """All days judged at once, for back-fill."""
    off = (F.col("value") < F.col("band_lo")) | (F.col("value") > F.col("band_hi"))
    return rolling_bands(daily, days, keys).where((F.col("n") > 0) & off)
