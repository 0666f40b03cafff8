"""The three daily flows, from input frames to stored partitions.

A store is a folder every executor can reach. Each flow reads history from it, writes the partitions of
its own day (and run) and can be repeated: a rerun replaces what it wrote. Between the steps of a flow
the written tables cut the lineage, so a lost executor costs one step and not the flow.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import MIB, as_date, midnight
from ..operators import metrics, volume
from ..operators.columns import column_catalog, profile_config
from ..operators.inventory import attach_status, build_inventory
from ..operators.profile import DIMENSION, empty_tables, profile_planned, run_plans, with_attributes
from ..operators.report import metric_lines, volume_lines
from ..operators.sizes import cutoff_table, daily_sizes, day_bytes, fold_state, hourly_sizes, size_state, state_status
from ..operators.sizes import unlisted_files
from ..sources.tables import days_between, exists, read_table, remove, write_partitions

#: Stored rows that the reports read.
CUTOFFS = "name string, source_kind string, status string, table_bytes long, queries long, partition_keys string, day date"
EVIDENCE = "name string, source_kind string, flag string, file_bytes long, update_time long, table_bytes long, queries long, day date"


def keep(df: DataFrame, store: str, table: str, by: list[str], **own) -> DataFrame:
    """Write the partitions in ``df`` and return the whole stored table.

    ``own`` is the run's partition, which is replaced even where ``df`` has no row of it.
    The schema is handed on, so a table nothing was written to yet reads as empty.
    """
    where = f"{store}/{table}"
    write_partitions(df, where, by, own=own)
    return read_table(df.sparkSession, where, schema=df.schema)


def read_or_empty(spark, location: str, schema) -> DataFrame:
    """A stored table, or no rows where nothing was stored yet."""
    return read_table(spark, location, schema=schema) if exists(spark, location) else spark.createDataFrame([], schema)


def until(df: DataFrame, as_of, days: int) -> DataFrame:
    """Partitions from ``days`` before the as-of day up to it."""
    day = as_date(as_of)
    return days_between(df, F.date_sub(day, days), day)


def watch_inventory(
    exports: DataFrame,
    events: DataFrame,
    shared: DataFrame,
    catalog: DataFrame,
    raw_logs: DataFrame,
    as_of,
    deny_schemas=(),
    deny_pattern: str | None = None,
) -> DataFrame:
    """Inventory of all sources with status, raw logs appended."""
    tables = build_inventory(exports, events, shared, deny_schemas, deny_pattern)
    known = attach_status(tables, catalog, as_of).where(F.col("path") != "")
    return known.unionByName(raw_logs)


def measure_day(
    store: str, files: DataFrame, inventory: DataFrame, as_of, registry: DataFrame | None = None
) -> DataFrame:
    """Measure a day from its own files and the stored state of the day before; returns the day's rows.

    Files of series that the inventory does not have are counted in ``unlisted_files`` of the store.
    ``files`` and ``registry`` need only hold the day, and files without one. The first run takes what it is given as
    the whole past. The state is a partition by day: a day whose files came late is measured again with the days after it.
    """
    day, spark = as_date(as_of), files.sparkSession
    days = day_bytes(files, registry).where(F.col("day") <= day)
    schema = size_state(days).withColumn("day", day).schema
    stored = read_or_empty(spark, f"{store}/size_state", schema).where(F.col("day") < day)
    before = stored.agg(F.max("day")).first()[0]
    if before is None:
        state = size_state(days)
    else:
        state = fold_state(stored.where(F.col("day") == F.lit(before)), days.where(F.col("day") > F.lit(before)))
    states = keep(state.withColumn("day", day), store, "size_state", ["day"], day=as_of)
    gaps = state_status(until(states, as_of, 0).drop("day"), days, as_of)
    keep(unlisted_files(files, inventory).withColumn("day", day), store, "unlisted_files", ["day"], day=as_of)
    sizes = daily_sizes(files, inventory, as_of, registry, gaps)
    return until(keep(sizes, store, "daily_sizes", ["day"], day=as_of), as_of, 0)


def watch_volumes(
    store: str,
    files: DataFrame,
    inventory: DataFrame,
    as_of,
    registry: DataFrame | None = None,
    whitelist: DataFrame | None = None,
    topic_pairs: DataFrame | None = None,
    min_bytes: int = 10 * MIB,
    **thresholds,
) -> DataFrame:
    """Measure the day, judge it by its history, store both and return the report lines."""
    sizes = keep(daily_sizes(files, inventory, as_of, registry), store, "daily_sizes", ["day"], day=as_of)
    cutoffs = keep(cutoff_table(until(sizes, as_of, 0)), store, "cutoffs", ["day"], day=as_of)
    history = volume.volume_history(until(sizes, as_of, 10), as_of, whitelist=whitelist)
    judged = volume.with_evidence(volume.score_volumes(history), as_of, min_bytes=min_bytes)
    anomalies = keep(judged, store, "volume_anomalies", ["day"], day=as_of)
    report = volume.daily_report(
        until(cutoffs, as_of, 1), until(anomalies, as_of, 0), inventory, as_of, whitelist, topic_pairs,
        **thresholds,
    )
    return volume_lines(report)


def watch_hour(
    store: str,
    files: DataFrame,
    inventory: DataFrame,
    as_of,
    hour: int,
    whitelist: DataFrame | None = None,
    min_bytes: int = MIB,
) -> DataFrame:
    """Measure one hour, judge it by the same hour of the days before, store both."""
    sizes = keep(hourly_sizes(files, inventory, as_of, hour), store, "hourly_sizes", ["day", "hour"], day=as_of, hour=hour)
    history = volume.volume_history(until(sizes, as_of, 10), as_of, hour, whitelist=whitelist)
    judged = volume.with_evidence(volume.score_volumes(history), as_of, hour, min_bytes)
    anomalies = keep(judged, store, "hourly_anomalies", ["day", "hour"], day=as_of, hour=hour)
    return until(anomalies, as_of, 0).where(F.col("hour") == hour)


def report_day(
    store: str,
    inventory: DataFrame,
    as_of,
    whitelist: DataFrame | None = None,
    topic_pairs: DataFrame | None = None,
    **thresholds,
) -> tuple[DataFrame, DataFrame]:
    """The summary of a day that ``watch_volumes`` has judged: what is new, recovered and fluctuating, ranked by use and
    size, and the number of abnormal tables by kind of status.

    The report is stored once and both are read from it.
    """
    spark, day = inventory.sparkSession, as_date(as_of)
    cutoffs = read_or_empty(spark, f"{store}/cutoffs", CUTOFFS)
    anomalies = read_or_empty(spark, f"{store}/volume_anomalies", EVIDENCE)
    report = volume.daily_report(
        until(cutoffs, as_of, 1), until(anomalies, as_of, 0), inventory, as_of, whitelist, topic_pairs, **thresholds
    )
    reports = keep(report.withColumn("as_of", day), store, "daily_report", ["as_of"], as_of=as_of)
    report = reports.where(F.col("as_of") == day).drop("as_of")
    place = f"{store}/_ranks/{uuid.uuid4().hex}"
    changes = volume.ranked_tables(volume.report_diff(report, as_of), place, ties=("source_kind", "change"))
    changes = keep(changes.withColumn("day", day), store, "report_changes", ["day"], day=as_of)
    remove(spark, place)
    tally = volume.status_tally(report.where(F.col("day") == day)).withColumn("day", day)
    return until(changes, as_of, 0), until(keep(tally, store, "report_tally", ["day"], day=as_of), as_of, 0)


def report_hour(
    store: str,
    inventory: DataFrame,
    as_of,
    hour: int,
    whitelist: DataFrame | None = None,
    topic_pairs: DataFrame | None = None,
    **thresholds,
) -> DataFrame:
    """Tables that ``watch_hour`` flagged in three hours in a row up to this one, stored by day and hour."""
    spark, day = inventory.sparkSession, as_date(as_of)
    anomalies = read_or_empty(spark, f"{store}/hourly_anomalies", f"{EVIDENCE}, hour int")
    cutoffs = read_or_empty(spark, f"{store}/cutoffs", CUTOFFS)
    at = midnight(day) + hour * 3600
    found = volume.hourly_report(anomalies, cutoffs, inventory, as_of, hour, at, whitelist, topic_pairs, **thresholds)
    reports = keep(found.withColumn("day", day), store, "hourly_report", ["day", "hour"], day=as_of, hour=hour)
    return until(reports, as_of, 0).where(F.col("hour") == hour)


def describe_columns(
    store: str,
    tables: DataFrame,
    catalog: DataFrame,
    columns: DataFrame,
    edges: DataFrame,
    trend: DataFrame,
    day_sizes: DataFrame,
    as_of,
) -> DataFrame:
    """Store the column catalog of the day and return the profile configuration made from it."""
    found = column_catalog(tables, catalog, columns, edges, trend, day_sizes, as_of)
    return profile_config(until(keep(found, store, "column_catalog", ["day"], day=as_of), as_of, 0))


def profile_run(
    store: str,
    tables: dict[str, DataFrame],
    config: DataFrame,
    as_of,
    run: str,
    group: int = 50,
    partitions: dict[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """Profile the tables that the configuration puts into a run into its (day, run_flag) partition; returns the metric
    history.

    The configuration also says which application's rules hold, which columns are of which class and which day to
    read. One job covers ``group`` tables, which bounds the plan however many tables there are. Parts are
    stored first and then replace the run's partition together; from them it is seen which tables had no row.
    """
    if not tables:
        raise ValueError(f"no tables to profile in run {run!r}")
    plans = run_plans(tables, config, run, partitions)
    names = sorted(plans)
    schema = f"{DIMENSION} string, metric string, metric_class string, value double, name string"
    parts = tables[next(iter(tables))].sparkSession.createDataFrame([], f"{schema}, day date, run_flag string, part int")
    for i in range(0, len(names), group):
        chosen = {n: plans[n] for n in names[i : i + group]}
        rows = profile_planned(tables, chosen, as_of).select(
            "*", as_date(as_of).alias("day"), F.lit(run).alias("run_flag"), F.lit(i // group).alias("part")
        )
        parts = keep(rows, store, "metric_parts", ["day", "run_flag", "part"], day=as_of, run_flag=run, part=i // group)
    mine = until(parts, as_of, 0).where((F.col("run_flag") == run) & (F.col("part") < -(-len(names) // group)))
    mine = mine.select(DIMENSION, "metric", "metric_class", "value", "name")
    mine = with_attributes(mine.unionByName(empty_tables(mine, names)), config, as_of, run)
    return keep(mine, store, "metric_history", ["day", "run_flag"], day=as_of, run_flag=run)


def watch_metrics(
    store: str,
    metric_rows: DataFrame,
    as_of,
    run: str,
    whitelist: DataFrame | None = None,
    days: int = 45,
    **gate,
) -> tuple[DataFrame, DataFrame]:
    """Judge a run's metrics, store the anomalies, return report lines and the missing/new summary."""
    rows = until(metric_rows, as_of, days)
    history = metrics.metric_history(rows, as_of, run, whitelist, days)
    flagged = metrics.flag_series(metrics.score_series(history, as_of), **gate)
    found = metrics.anomaly_rows(metrics.with_evidence(flagged, as_of), rows, as_of, run)
    keep(found, store, "metric_anomalies", ["day", "run_flag"], day=as_of, run_flag=run)
    off = metrics.metric_anomalies(flagged).join(metrics.table_attributes(rows, as_of), "name", "left")
    return metric_lines(off), metrics.missing_new_summary(flagged)
