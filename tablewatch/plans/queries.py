"""Queries registered for the supplied tables, one per operator or group of operators.

Every query calls the library on frames derived from whole tables. As-of days lie at the end of the
data and history windows reach back to its start.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from ..functions import names, rules, text
from ..functions.bands import VOLUME, add_bands, rolling_sums
from ..operators import columns, inventory, metrics, profile, report, sizes, usage, volume
from ..session import shared_dir
from ..sources.files import describe_files, stored_files
from ..sources.files import partition_gaps as find_gaps
from ..sources.tables import days_between, overwrite_table, read_days, read_list, read_table, write_partitions
from . import feeds, flows

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

EVENT_DAY = "2024-01-30"
EVENT_DAYS = 29
SALES_DAY = feeds.LAUNCH_DAY
SALES_DAYS = 2500
GAP_DAY = "2001-07-20"
PROFILE_DAY = "1997-03-01"
MIN_BYTES = 1000


def query(f: Query) -> Query:
    REGISTRY[f.__name__] = f
    return f


# --- names and predicates


@query
def norm_name(spark, sf):
    p = feeds.table(spark, sf, "part")
    return p.select(
        "p_partkey", names.qualified_name("p_brand", "p_type").alias("name"),
        names.clean_name("p_name").alias("bare"),
    )


@query
def exclude_names(spark, sf):
    p = feeds.catalog(spark, sf)
    return p.where(names.keep_name("name", ["brand_1", "brand_7"], "promo")).select("p_partkey", "name")


@query
def series_identity(spark, sf):
    return feeds.watched(spark, sf).select(names.series_name().alias("series"), "source_kind")


@query
def repaired_paths(spark, sf):
    c = feeds.catalog(spark, sf)
    bare = F.element_at(F.split("name", "\\."), -1)
    return c.select("name", names.repair_location("location", bare).alias("path"))


@query
def path_parts(spark, sf):
    f = describe_files(feeds.listing(spark, sf))
    return f.select("path", "name", "event_id", "day", "hour", F.col("length").cast("long").alias("length"))


@query
def important_tables(spark, sf):
    return volume.important_tables(
        feeds.watched(spark, sf), idle_bytes=20000, few_bytes=15000
    )


@query
def run_split(spark, sf):
    c = feeds.catalog(spark, sf)
    flag = rules.run_flag(rules.epoch_ms_clock("updated_ms"), F.lower("partition_keys"))
    return c.select("name", rules.epoch_ms_clock("updated_ms").alias("update_clock"), flag.alias("run_flag"))


@query
def catalog_admission(spark, sf):
    c = inventory.admit_catalog(feeds.catalog(spark, sf), feeds.CATALOG_DAY, "brand_[1-9]", "temp|tmp", 60)
    return c.select("name", "bytes", "queries")


# --- inventory and usage


@query
def inventory_sources(spark, sf):
    return inventory.build_inventory(
        inventory.export_tables(feeds.export_tasks(spark, sf), **feeds.EXPORTS),
        inventory.event_tables(feeds.event_configs(spark, sf)),
        feeds.shared_events(spark, sf),
        ["brand#3", "brand#21"],
        "promo",
    )


@query
def catalog_status(spark, sf):
    found = feeds.catalog(spark, sf)
    wanted = found.select("name").unionByName(feeds.shared_events(spark, sf).select("name").distinct())
    tagged = wanted.select("name", F.lit("event").alias("source_kind"), F.lit("").alias("event_id"))
    return inventory.attach_status(tagged, found, feeds.CATALOG_DAY)


@query
def usage_by_path(spark, sf):
    audit = feeds.path_audit(spark, sf)
    return usage.usage_by_table(
        audit, audit, [feeds.excluded_apps(spark, sf)], feeds.AUDIT_DAY, feeds.AUDIT_ROOT
    )


@query
def usage_two_logs(spark, sf):
    """Two audit logs that hold different reads, the first of them read for the day before only; of the applications to
    leave out only those of one user count."""
    audit, first = feeds.path_audit(spark, sf), F.col("src").endswith("1")
    user = F.when(F.col("app_id").endswith("0"), "robot").otherwise("ann")
    apps = feeds.excluded_apps(spark, sf).withColumn("user", user)
    return usage.usage_by_table(
        audit.where(first), audit.where(~first), [apps], feeds.AUDIT_DAY, feeds.AUDIT_ROOT, ["robot"]
    )


@query
def usage_windows(spark, sf):
    """Applications of each directory over windows of one, two and three days, merged from bitmaps of single days."""
    apart = feeds.path_audit(spark, sf).withColumn("day", F.date_sub("day", (F.length("src") % 4).cast("int")))
    return usage.usage_windows(usage.usage_bitmaps(apart, feeds.AUDIT_ROOT), feeds.AUDIT_DAY, (1, 2, 3))


@query
def recent_usage(spark, sf):
    """Directories used now, joined by raw logs used earlier."""
    days = feeds.measured_days(spark, sf)
    recent = usage.recent_active(days, EVENT_DAY, EVENT_DAYS + 1, 2)
    now = days_between(days, EVENT_DAY, EVENT_DAY).where("source_kind = 'raw_log'").groupBy("name").agg(
        F.sum("queries").alias("queries")
    )
    return inventory.merge_usage(now, recent)


@query
def usage_admission(spark, sf):
    f = feeds.files(spark, sf)
    used = usage.recent_active(feeds.measured_days(spark, sf), EVENT_DAY, EVENT_DAYS + 1, 2)
    used = used.withColumn("queries", F.lit(5).cast("long"))
    return inventory.raw_log_inventory(f, used, "/logs", 120000).drop("event_id")


@query
def table_mentions(spark, sf):
    return usage.mentioned_tables(
        feeds.statements(spark, sf), feeds.candidates(spark, sf), feeds.AUDIT_DAY, ["src3", "src7"]
    )


@query
def prefer_source(spark, sf):
    """Mentioned tables against a business list of brands and types."""
    mentions = feeds.catalog(spark, sf).select(F.lower("real_owner").alias("name")).where("name != ''")
    business = feeds.table(spark, sf, "part").select(
        F.lower("p_brand").alias("app_name"), F.col("p_name").alias("name"), F.lower("p_type").alias("table_source")
    )
    listed = feeds.table(spark, sf, "part").where("p_name like 'hot %'").select(F.col("p_name").alias("name"))
    return usage.monitored_tables(mentions, business, listed)


# --- columns


@query
def downstream_owners(spark, sf):
    return columns.downstream_owners(feeds.edges(spark, sf), "1998-06-15")


@query
def downstream_counts(spark, sf):
    return columns.downstream_count(feeds.edges(spark, sf), "1998-06-15")


@query
def avg_day_bytes(spark, sf):
    c = feeds.catalog(spark, sf).select("name", F.col("bytes").alias("table_bytes"), "partition_keys")
    t = feeds.trend(spark, sf)
    return columns.avg_day_bytes(c, t, t, "2001-07-01", SALES_DAYS)


@query
def effective_day(spark, sf):
    c = feeds.catalog(spark, sf).select("name", "partition_keys")
    return columns.effective_day(c, feeds.trend(spark, sf), "2001-07-01")


@query
def column_catalog(spark, sf):
    c = feeds.catalog(spark, sf)
    app = F.when(F.col("p_partkey") % 2 == 0, "dw").otherwise("shop")
    tables = c.select("name", app.alias("app_name"), F.lit("listed").alias("table_source"))
    t = feeds.trend(spark, sf)
    return columns.column_catalog(
        tables, c, feeds.catalog_columns(spark, sf), feeds.edges(spark, sf), t, t, feeds.CATALOG_DAY, 60
    )


@query
def classify_columns(spark, sf):
    """Every word of the documents taken as a column name, typed by its length."""
    words = F.explode(F.split(F.lower("text"), "[^a-z0-9_]+")).alias("column_name")
    d = feeds.table(spark, sf, "documents").select("lang", words).where("column_name != ''").distinct()
    kind = F.element_at(
        F.array(*[F.lit(t) for t in ("string", "bigint", "double", "array<int>", "decimal(10,2)")]),
        F.length("column_name") % 5 + 1,
    )
    named = d.withColumn("column_type", kind).withColumn(
        "app_name", F.when(F.col("lang") == "en", "dw").otherwise("shop")
    )
    return named.select("lang", "column_name", "column_type", columns.column_class().alias("column_class"))


@query
def column_sets(spark, sf):
    c = feeds.catalog_columns(spark, sf).withColumn("app_name", F.lit("shop"))
    sets = columns.column_sets(c)
    return sets.select("name", *[F.concat_ws(",", k).alias(k) for k in ("uid", "string_id", "num_id", "not_monitor", "values", "attributes")])


@query
def profile_config(spark, sf):
    """Tables with their columns by class, as the profile runs take them."""
    c = feeds.catalog(spark, sf).select(
        "name", F.lit("shop").alias("app_name"), F.col("owner"), F.lower("partition_keys").alias("partition_keys"),
        F.col("bytes").alias("table_bytes"), rules.epoch_ms_clock("updated_ms").alias("update_clock"),
        "queries", (F.col("bytes") % 1000).alias("day_bytes"), F.lit("").alias("downstream"),
    )
    config = columns.profile_config(c.join(feeds.catalog_columns(spark, sf), "name"), "else")
    return config.select(
        "name", "owner", "update_clock", "day_bytes", "run_flag",
        *[F.concat_ws(",", k).alias(k) for k in ("uid", "num_id", "values")],
    )


# --- profiles


def _as_doubles(df):
    """Exact sums as the metric history keeps them."""
    return df.select(*[F.col(f.name).cast("double") if isinstance(f.dataType, DecimalType) else f.name for f in df.schema])


@query
def profile_orders(spark, sf):
    """Order metrics by area and system; one measure is so large that its sums pass 64 bits."""
    s = feeds.sales(spark, sf).withColumn("gross_amount", F.col("total_amount") * 2**36)
    classes = columns.classify_schema(s.schema, skip=("day",))
    return _as_doubles(profile.profile(s, classes, ["os", "area"]))


@query
def profile_customer_ids(spark, sf):
    c = feeds.table(spark, sf, "customer").withColumn("balance", feeds.cents("c_acctbal"))
    classes = {
        "c_custkey": "uid", "c_name": "string_id", "c_nationkey": "num_id",
        "balance": "values", "c_mktsegment": "attributes", "c_acctbal": "attributes",
    }
    return _as_doubles(profile.profile(c, classes))


@query
def melt_lineitem(spark, sf):
    i = feeds.items(spark, sf)
    plan = columns.table_profile(i.schema, skip=("day",))
    return profile.profile_long(i, plan.classes, plan.dims)


@query
def profile_tables(spark, sf):
    """Several tables profiled in one job, whole, with attributes for the history."""
    tables = {
        "shop.sales": feeds.sales(spark, sf).drop("day"),
        "shop.items": feeds.items(spark, sf).drop("day"),
        "app.actions": feeds.actions(spark, sf).drop("day"),
    }
    config = feeds.sales(spark, sf).groupBy("os").agg(F.count("*").alias("table_bytes"))
    name = F.when(F.col("os") == "F", "shop.sales").when(F.col("os") == "O", "shop.items").otherwise("app.actions")
    config = config.select(
        name.alias("name"), F.lit("shop").alias("app_name"), F.lit("ann").alias("owner"),
        F.lit("day").alias("partition_keys"), "table_bytes", F.lit(1).alias("queries"),
        F.lit(10).alias("day_bytes"), F.lit("").alias("downstream"),
    )
    return profile.profile_all(tables, config, SALES_DAY, "early")


@query
def profile_by_config(spark, sf):
    """Two runs as the configuration has them: an early table, one of the warehouse's own application, one without rows
    on the day, and in the later run one that is read a day behind."""
    store = f"{shared_dir(spark)}/tablewatch/{uuid.uuid4().hex}"
    sales = feeds.sales(spark, sf).withColumn("day", F.trunc("day", "month"))
    tables = {
        "shop.sales": sales,
        "dw.sales": sales,
        "app.actions": feeds.actions(spark, sf),
        "shop.items": feeds.items(spark, sf).withColumn("day", F.last_day("day")),
    }
    schemas = [(n, n.split(".")[0], f.name, f.dataType.simpleString()) for n, df in tables.items() for f in df.schema]
    listed = spark.createDataFrame(schemas, "name string, app_name string, column_name string, column_type string")
    behind = F.col("name") == "shop.items"
    catalog = sales.agg(F.count("*").alias("table_bytes")).join(listed).select(
        "name", "app_name", F.lit("ann").alias("owner"), F.lit("day").alias("partition_keys"), "table_bytes",
        F.when(behind, "09:00:00").otherwise("06:00:00").alias("update_clock"), F.lit(3).alias("queries"),
        F.lit(10).alias("day_bytes"), F.lit("bob").alias("downstream"), "column_name", "column_type",
        F.date_sub(F.lit(PROFILE_DAY).cast("date"), behind.cast("int")).alias("read_day"),
    )
    config = columns.profile_config(catalog)
    for run in ("early", "else"):
        history = flows.profile_run(store, tables, config, PROFILE_DAY, run, group=2)
    return history


@query
def dimension_keys(spark, sf):
    """Dimension text with missing values: small orders have no status."""
    s = feeds.sales(spark, sf).withColumn("os", F.when(F.col("total_amount") >= 2_000_000, F.col("os")))
    return s.groupBy("os", "area").count().select(
        profile.dimension_key(["os", "area"]).alias("dimension"), F.col("count").alias("row_num")
    )


# --- sizes


@query
def day_sizes_events(spark, sf):
    return sizes.day_bytes(feeds.files(spark, sf), feeds.registry(spark, sf))


@query
def hour_sizes_events(spark, sf):
    f = feeds.files(spark, sf)
    return sizes.hour_bytes(f, F.col("name") != "click")


@query
def hour_sizes_written(spark, sf):
    """The same where files are written three hours after the hour they belong to."""
    late = F.col("modificationTime") + F.expr("interval 3 hours")
    return sizes.hour_bytes(feeds.files(spark, sf).withColumn("modificationTime", late), F.col("name") != "click")


@query
def undated_files(spark, sf):
    """Rows of the daily sizes that tell of files without a valid day: here those of every fifth hour."""
    f = feeds.files(spark, sf).withColumn("day", F.when(F.col("hour") % 5 != 0, F.col("day")))
    found = sizes.daily_sizes(f, feeds.watched(spark, sf), EVENT_DAY, feeds.registry(spark, sf))
    return found.where(F.col("status").startswith("InvalidDay")).select(
        "name", "event_id", "source_kind", "file_bytes", "status"
    )


@query
def unlisted_files(spark, sf):
    """Files of tables that an inventory of the more used ones does not have."""
    return sizes.unlisted_files(feeds.files(spark, sf), feeds.watched(spark, sf).where("queries > 3"))


@query
def latest_partitions(spark, sf):
    return sizes.recent_partitions(feeds.order_days(spark, sf), 110)


@query
def gap_status(spark, sf):
    g = sizes.gap_status(feeds.order_days(spark, sf), GAP_DAY)
    return g.select("name", "event_id", "file_bytes", "total_bytes", "empty_since", "last_day", "status")


@query
def folded_sizes(spark, sf):
    """The same from a stored state three weeks old and the weeks since, folded one after another."""
    store, days = f"{shared_dir(spark)}/tablewatch/{uuid.uuid4().hex}", feeds.order_days(spark, sf)
    ends = ["2001-06-29", "2001-07-06", "2001-07-13", GAP_DAY]
    state = sizes.size_state(days.where(F.col("day") <= F.lit(ends[0])))
    for since, end in zip(ends, ends[1:]):
        state.write.parquet(f"{store}/{since}")
        state = spark.read.schema(state.schema).parquet(f"{store}/{since}")
        state = sizes.fold_state(state, days.where((F.col("day") > F.lit(since)) & (F.col("day") <= F.lit(end))))
    g = sizes.state_status(state, days, GAP_DAY)
    return g.select("name", "event_id", "file_bytes", "total_bytes", "empty_since", "last_day", "status")


@query
def full_freshness(spark, sf):
    g = sizes.full_table_freshness(feeds.files(spark, sf), "2024-01-31")
    return g.select("name", "event_id", "file_bytes", "status")


@query
def daily_sizes(spark, sf):
    f = feeds.files(spark, sf)
    return sizes.daily_sizes(f, feeds.watched(spark, sf), EVENT_DAY, feeds.registry(spark, sf))


@query
def hourly_sizes(spark, sf):
    f = feeds.files(spark, sf)
    return sizes.hourly_sizes(f, feeds.watched(spark, sf), EVENT_DAY, 9, feeds.registry(spark, sf))


@query
def cutoff_tables(spark, sf):
    f = feeds.files(spark, sf)
    return sizes.cutoff_table(sizes.daily_sizes(f, feeds.watched(spark, sf), EVENT_DAY, feeds.registry(spark, sf)))


# --- volumes


def _volume_history(spark, sf):
    listed = feeds.watched(spark, sf).where("queries = 3").select(names.series_name().alias("name"))
    return volume.volume_history(
        feeds.measured_days(spark, sf), EVENT_DAY, days=EVENT_DAYS, whitelist=listed,
        old_path="/old/", new_path="/new/", deny_pattern="error_3",
    )


@query
def volume_history(spark, sf):
    return _volume_history(spark, sf)


@query
def band_volume(spark, sf):
    scored = volume.score_volumes(_volume_history(spark, sf))
    return scored.select(
        *volume.KEYS, "file_bytes", "n", "std_lo", "std_hi", "trend_lo", "trend_hi", "band_lo", "band_hi", "centre"
    )


@query
def volume_anomalies(spark, sf):
    scored = volume.score_volumes(_volume_history(spark, sf))
    return volume.volume_anomalies(scored, MIN_BYTES).select(*volume.KEYS, "file_bytes", "band_lo", "band_hi")


@query
def missing_volumes(spark, sf):
    scored = volume.score_volumes(_volume_history(spark, sf))
    return volume.missing_volumes(scored, MIN_BYTES).select(*volume.KEYS, "n", "trend_lo", "trend_hi")


@query
def volume_evidence(spark, sf):
    scored = volume.score_volumes(_volume_history(spark, sf))
    return volume.with_evidence(scored, EVENT_DAY, min_bytes=MIN_BYTES)


@query
def rolling_volumes(spark, sf):
    rows = volume.rolling_volume_anomalies(feeds.measured_days(spark, sf), 10, MIN_BYTES)
    return rows.select(*volume.KEYS, "day", "file_bytes", "n", "band_lo", "band_hi", "centre")


@query
def topic_pairs(spark, sf):
    return volume.topics(
        inventory.export_tables(feeds.export_tasks(spark, sf), **feeds.EXPORTS),
        inventory.event_tables(feeds.event_configs(spark, sf)),
    )


def _daily_report(spark, sf):
    """Cut-off rows and moving volumes of the event tables, with their topics."""
    days = feeds.measured_days(spark, sf)
    cut = sizes.cutoff_table(days).withColumn("table_bytes", F.col("table_bytes") * 50)
    scored = volume.score_volumes(_volume_history(spark, sf))
    moved = volume.with_evidence(scored, EVENT_DAY, min_bytes=MIN_BYTES)
    topic = feeds.table(spark, sf, "events").select(
        F.concat("event_type", F.lit("_"), F.col("user_id").cast("string")).alias("name"),
        F.concat(F.lit("topic_"), (F.col("event_id") % 2).cast("string")).alias("topic"),
    ).distinct()
    return volume.daily_report(
        cut, moved, feeds.watched(spark, sf), EVENT_DAY, topic_pairs=topic, raw_root="/logs",
        idle_bytes=20000, few_bytes=15000,
    )


@query
def daily_report(spark, sf):
    return _daily_report(spark, sf)


@query
def report_diff(spark, sf):
    return volume.report_diff(_daily_report(spark, sf), EVENT_DAY)


@query
def ranked_tables(spark, sf):
    """All tables of the catalog with their rank by use and size."""
    rows = feeds.catalog(spark, sf).select("name", F.col("bytes").alias("table_bytes"), "queries")
    return volume.ranked_tables(rows, f"{shared_dir(spark)}/tablewatch/{uuid.uuid4().hex}")


@query
def ranked_changes(spark, sf):
    """What changed since the day before, with its rank."""
    changes = volume.report_diff(_daily_report(spark, sf), EVENT_DAY)
    return volume.ranked_tables(changes, f"{shared_dir(spark)}/tablewatch/{uuid.uuid4().hex}", ("source_kind", "change"))


@query
def report_tally(spark, sf):
    """Abnormal tables of the daily report by kind of status."""
    return volume.status_tally(_daily_report(spark, sf))


@query
def volume_report(spark, sf):
    return report.volume_lines(_daily_report(spark, sf)).drop("table_bytes")


@query
def status_tally(spark, sf):
    g = sizes.gap_status(feeds.order_days(spark, sf), GAP_DAY).where("status != 'normal'")
    return volume.status_tally(
        g.select(F.lit("event").alias("source_kind"), names.series_name("name", "event_id", F.lit("shared_event")).alias("name"), "status")
    )


@query
def streak_hours(spark, sf):
    return volume.rolling_streaks(feeds.hour_flags(spark, sf), ["source_kind", "name"])


@query
def hourly_report(spark, sf):
    """Flagged hours of event types that are important by the use of their tables."""
    flags = feeds.hour_flags(spark, sf)
    watched = feeds.watched(spark, sf).select(
        F.element_at(F.split("name", "_"), 1).alias("name"), "table_bytes", "queries"
    )
    merged = watched.groupBy("name").agg(
        F.sum("table_bytes").alias("table_bytes"), F.sum("queries").alias("queries")
    ).select(
        "name", F.lit("").alias("event_id"), F.lit("event").alias("source_kind"),
        F.concat(F.lit("/logs/"), F.col("name")).alias("path"), "table_bytes", "queries",
    )
    cut = sizes.cutoff_table(feeds.measured_days(spark, sf))
    at = 1_706_572_800 + 17 * 3600
    return volume.hourly_report(flags, cut, merged, EVENT_DAY, 17, at)


# --- metrics


@query
def metric_shares(spark, sf):
    rows = metrics.add_totals(feeds.sales_metrics(spark, sf))
    return rows.select(
        "name", "day", "dimension", "metric", "value", "total_value", "row_num", "total_rows", "value_share", "row_share"
    )


def _sales_history(spark, sf, rows=None):
    rows = feeds.sales_metrics(spark, sf) if rows is None else rows
    return metrics.metric_history(
        rows, SALES_DAY, "early", days=SALES_DAYS, max_rows=2, row_bytes=1024**2, deny_dimension="urgent,os:p"
    )


def _run_rows(spark, sf, rows=None):
    return metrics.metric_history(
        feeds.sales_metrics(spark, sf) if rows is None else rows, SALES_DAY, "early", days=SALES_DAYS, max_rows=0
    )


@query
def metric_history(spark, sf):
    """Exclusions lowered to the data: short dimensions, thin groups and a denied dimension."""
    return _sales_history(spark, sf).select("day", "dimension", "metric", "value", "value_share", "row_share")


@query
def whitelist_columns(spark, sf):
    """Sales metrics without the columns and tables named in a list made of regions and nations."""
    listed = feeds.table(spark, sf, "region").select(
        F.lower("r_name").alias("name"),
        F.when(F.col("r_name") == "ASIA", "total_amount").when(F.col("r_name") == "EUROPE", "row_num")
        .otherwise(F.lower("r_name")).alias("column_name"),
    )
    rows = metrics.drop_whitelisted(feeds.sales_metrics(spark, sf), listed)
    return rows.select("name", "day", "dimension", "metric", "value")


@query
def share_medians(spark, sf):
    scored = metrics.score_series(_run_rows(spark, sf), SALES_DAY)
    return scored.select("dimension", "metric", "n", "usual_value_share", "usual_row_share")


@query
def band_metric(spark, sf):
    scored = metrics.score_series(_run_rows(spark, sf), SALES_DAY)
    return scored.select(
        "dimension", "metric", "metric_class", "value", "n", "std_lo", "std_hi", "trend_lo", "trend_hi",
        "band_lo", "band_hi", "centre",
    )


def _flagged_sales(spark, sf):
    rows = feeds.sales_metrics_with_launch(spark, sf)
    history = _run_rows(spark, sf, rows)
    return rows, metrics.flag_series(metrics.score_series(history, SALES_DAY), min_rate=0.5, min_count=1)


@query
def metric_anomalies(spark, sf):
    """Judged by the most selective gate that leaves rows: the default share of 3 %."""
    flagged = metrics.metric_anomalies(_flagged_sales(spark, sf)[1])
    return flagged.select("dimension", "metric", "value", "value_share", "band_lo", "band_hi", "centre")


@query
def new_series(spark, sf):
    flagged = metrics.new_series(_flagged_sales(spark, sf)[1])
    return metrics.with_evidence(flagged, SALES_DAY).drop("flag")


@query
def missing_series(spark, sf):
    flagged = metrics.missing_series(_flagged_sales(spark, sf)[1])
    return flagged.select("dimension", "metric", "metric_class", "n")


@query
def metric_evidence(spark, sf):
    rows, flagged = _flagged_sales(spark, sf)
    evidence = metrics.with_evidence(flagged, SALES_DAY)
    return metrics.anomaly_rows(evidence, rows, SALES_DAY, "early")


@query
def missing_new_summary(spark, sf):
    return metrics.missing_new_summary(_flagged_sales(spark, sf)[1])


@query
def metric_report(spark, sf):
    rows, flagged = _flagged_sales(spark, sf)
    off = metrics.metric_anomalies(flagged).join(metrics.table_attributes(rows, SALES_DAY), "name", "left")
    return report.metric_lines(off)


@query
def retention_shift(spark, sf):
    rows = feeds.return_metrics(spark, sf)
    history = metrics.metric_history(rows, EVENT_DAY, "early", days=EVENT_DAYS)
    scored = metrics.score_series(history, EVENT_DAY)
    return scored.select("metric", "series_day", "value", "n", "sum_y", "band_lo", "band_hi")


@query
def rolling_metrics(spark, sf):
    """Every metric of every line item group, judged on every day by the 45 days before it."""
    daily = feeds.daily_metrics(feeds.items(spark, sf))
    rows = metrics.rolling_anomalies(daily, 45, ["dimension", "metric"])
    return rows.select("day", "dimension", "metric", "value", "n", "band_lo", "band_hi")


@query
def rolling_quantity(spark, sf):
    """Daily quantity per return flag and line status against the ten days before."""
    daily = feeds.items(spark, sf).groupBy("day", "region", "os").agg(F.sum("quantity_num").alias("value"))
    scored = add_bands(rolling_sums(daily, ["region", "os"], "value", 10), VOLUME)
    off = (F.col("value") < F.col("band_lo")) | (F.col("value") > F.col("band_hi"))
    return scored.select("day", "region", "os", "value", "n", "band_lo", "band_hi", off.alias("outside"))


# --- report texts


@query
def format_report(spark, sf):
    o = feeds.table(spark, sf, "orders").withColumn("bytes", F.col("o_orderkey") * feeds.cents("o_totalprice"))
    value = feeds.cents("o_totalprice")
    return o.select(
        "o_orderkey",
        text.fmt_bytes("bytes").alias("table_size"),
        text.fmt_file_bytes(F.col("bytes") * 8).alias("file_size"),
        text.fmt_number(value).alias("number"),
        text.metric_label(F.concat("o_orderstatus", F.lit("_sum_poly1"))).alias("label"),
        text.ratio_text(value, F.lit(1024.0)).alias("ratio"),
        text.first_users(F.concat_ws(",", "o_orderpriority", "o_orderstatus", F.lit("b"), F.lit("a"))).alias("users"),
    )


# --- sources and sinks


def _stored_events(spark, sf, day, place="events"):
    """The events as a stored table by day."""
    where = f"{shared_dir(spark)}/tablewatch/{uuid.uuid4().hex}/{place}"
    rows = feeds.table(spark, sf, "events").select("event_id", "user_id", "value", day.alias("day"))
    write_partitions(rows, where, ["day"])
    return where


@query
def inventory_files(spark, sf):
    """Files of a table stored by day as its rows tell them: the last ten days, with their number of rows."""
    where = _stored_events(spark, sf, F.to_date("ts"))
    found = stored_files(read_days(spark, where, EVENT_DAY[:8] + "21", EVENT_DAY))
    return found.groupBy("name", "day").agg(
        F.sum("rows").alias("n"), F.bool_and(F.col("length") > 0).alias("filled"),
        F.bool_and(F.col("path").endswith(".orc")).alias("orc"),
    )


@query
def string_days(spark, sf):
    """Rows of a range of days of a table whose days are text, some of it no day."""
    day = F.date_format("ts", "yyyy-MM-dd")
    where = _stored_events(spark, sf, F.when(F.col("user_id") % 10 == 0, "tmp").when(F.col("user_id") % 10 == 1, F.concat(day, F.lit("x"))).otherwise(day))
    schema = "event_id bigint, user_id bigint, value double, day string"
    return read_days(spark, where, "2024-01-05", EVENT_DAY, schema=schema).select("event_id", "user_id", "day")


@query
def partition_gaps(spark, sf):
    """Days on which a table should have a partition and has none, or one without bytes."""
    known = feeds.files(spark, sf).withColumn("length", F.when(F.dayofmonth("day") % 7 == 0, 0).otherwise(F.col("length")))
    return find_gaps(known, feeds.watched(spark, sf), "2024-01-01", EVENT_DAY)


def _two_runs(spark, sf):
    """Row counts of the sales by area and system as two runs, with a day for each year."""
    rows = feeds.sales_metrics(spark, sf).where("metric = 'row_num'").withColumn("run_day", F.trunc("day", "year"))
    other = rows.withColumn("run_flag", F.lit("else")).withColumn("value", F.col("value") + 1)
    return rows.unionByName(other).select("day", "dimension", "value", "run_flag", "run_day")


@query
def partition_switch(spark, sf):
    """Reruns of one day and run: one reads what it replaces, one has no rows; the other runs stay."""
    where = f"{shared_dir(spark)}/tablewatch/{uuid.uuid4().hex}/metric_history"
    by, schema = ["run_day", "run_flag"], _two_runs(spark, sf).schema
    write_partitions(_two_runs(spark, sf), where, by)
    again = read_table(spark, where, schema=schema).where("run_day = '1995-01-01' and run_flag = 'early'")
    write_partitions(again.withColumn("value", F.col("value") * 2), where, by, own={"run_day": "1995-01-01", "run_flag": "early"})
    none = _two_runs(spark, sf).where("value < 0")
    write_partitions(none, where, by, own={"run_day": "1996-01-01", "run_flag": "else"})
    return read_table(spark, where, schema=schema)


@query
def catalog_rerun(spark, sf):
    """The same with a table of the catalog, whose entry is pointed at the new rows."""
    name = f"tablewatch_{uuid.uuid4().hex}"
    where = f"{shared_dir(spark)}/tablewatch/{name}"
    first = _two_runs(spark, sf).withColumn("run_day", F.col("run_day").cast("string"))
    spark.sql(
        f"create table {name} (day date, dimension string, value double, run_flag string, run_day string) "
        f"using parquet partitioned by (run_day, run_flag) location '{where}'"
    )
    overwrite_table(first, name)
    again = spark.table(name).where("run_day = '1995-01-01' and run_flag = 'early'")
    overwrite_table(again.withColumn("value", F.col("value") * 2), name, {"run_day": "1995-01-01", "run_flag": "early"})
    overwrite_table(first.where("value < 0"), name, {"run_day": "1996-01-01", "run_flag": "else"})
    return spark.table(name)


@query
def partition_rerun(spark, sf):
    """Metric rows stored by day and run; a second write of the same run replaces the first."""
    where = f"{shared_dir(spark)}/tablewatch/{uuid.uuid4().hex}/metric_history"
    rows = feeds.sales_metrics(spark, sf).where("metric = 'row_num'")
    stored = rows.withColumn("run_day", F.trunc("day", "year"))
    write_partitions(stored, where, ["run_day", "run_flag"])
    write_partitions(stored.withColumn("value", F.col("value") * 2), where, ["run_day", "run_flag"])
    return read_days(spark, where, "1996-01-01", "2001-01-01", column="run_day").select(
        "day", "dimension", "value", "run_flag"
    )


@query
def csv_list(spark, sf):
    """A hand-kept list written as delimited text and read with its schema, then used to exclude."""
    where = f"{shared_dir(spark)}/tablewatch/{uuid.uuid4().hex}/whitelist"
    listed = feeds.table(spark, sf, "part").select(
        F.col("p_brand").alias("name"), F.concat(F.col("p_type"), F.lit("\\,x")).alias("column_name")
    ).distinct()
    listed.select(F.concat_ws(",", "name", "column_name")).write.text(where)
    back = read_list(spark, where, StructType().add("name", "string").add("column_name", "string"))
    return back.select("name", "column_name")
