"""Bytes per table, day and hour, and what gaps in them mean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import series_name
from ..functions.rules import age_label, as_date, is_measured
from .joins import without

SERIES = ["name", "event_id"]
#: What is known of a series after some days.
STATE = ["total_bytes", "last_day", "full_day", "empty_since"]


def _age_status(prefix: str, since: Column, as_of) -> Column:
    days = F.datediff(as_date(as_of), since)
    return age_label(prefix, days, days + 1, 100)


def day_bytes(files: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Bytes per series and day. Registered partitions without files count as 0 bytes.

    Registry rows join the sum as zero-byte rows, so there is no join and partial aggregation
    collapses a table with most of the files before the shuffle.
    """
    rows = files.where(F.col("day").isNotNull()).select(*SERIES, "day", "length")
    if registry is not None:
        known = registry.where(F.col("day").isNotNull()).select(
            *SERIES, "day", F.lit(0).cast("long").alias("length")
        )
        rows = rows.unionByName(known)
    return rows.groupBy(*SERIES, "day").agg(F.sum("length").alias("bytes"))


def hour_bytes(files: DataFrame, by_mtime: Column | None = None) -> DataFrame:
    """Bytes per series, day and hour; ``by_mtime`` marks rows whose hour is the file's own age."""
    written = F.hour("modificationTime")
    hour = F.col("hour") if by_mtime is None else F.when(by_mtime, written).otherwise(F.col("hour"))
    return (
        files.where(F.col("day").isNotNull())
        .groupBy(*SERIES, "day", hour.alias("hour"))
        .agg(F.sum("length").alias("bytes"))
    )


def _without_day(files: DataFrame, inventory: DataFrame) -> DataFrame:
    """Inventory rows with files whose day is missing or malformed: their bytes, and their number in the status.

    Exports without day partitions have none by design. One row per series meets the inventory.
    """
    keys = F.coalesce(F.col("partition_keys"), F.lit(""))
    dayless = (F.col("source_kind") == "db_export") & ((keys == "") | keys.contains("mon"))
    found = files.where(F.col("day").isNull()).groupBy(*SERIES).agg(
        F.sum("length").alias("file_bytes"), F.count("*").alias("_files")
    )
    status = F.concat(F.lit("InvalidDay"), F.col("_files").cast("string"), F.lit("Files"))
    known = inventory.where(~F.coalesce(dayless, F.lit(False))).drop("status", "file_bytes")
    return known.join(found, SERIES).withColumn("status", status)


def unlisted_files(files: DataFrame, inventory: DataFrame) -> DataFrame:
    """Files of series that the inventory does not have: their number and bytes by series, with or without a valid day.

    One aggregate comes before the join, so a series costs a row however many files it has.
    """
    found = files.groupBy(*SERIES).agg(F.count("*").alias("files"), F.sum("length").alias("file_bytes"))
    return without(found, inventory, SERIES)


def recent_partitions(days: DataFrame, n: int = 110, keys: list[str] = SERIES) -> DataFrame:
    """The latest ``n`` partitions of every series (one row per series and day)."""
    latest = Window.partitionBy(*keys).orderBy(F.desc("day"))
    return days.withColumn("_n", F.row_number().over(latest)).where(F.col("_n") <= n).drop("_n")


def size_state(days: DataFrame, keys: list[str] = SERIES) -> DataFrame:
    """What a series' days so far come down to: bytes in all, last day, last full day, and the first of the empty days
    after it.

    Input has one row per series and day, so the window group is no longer than the calendar and
    the aggregate that follows reuses its partitioning.
    """
    series = Window.partitionBy(*keys)
    full_day = F.when(F.col("bytes") > 0, F.col("day"))
    known = days.withColumn("_full", F.max(full_day).over(series))
    trailing = (F.col("bytes") == 0) & (F.col("_full").isNull() | (F.col("day") > F.col("_full")))
    return known.groupBy(*keys).agg(
        F.sum("bytes").alias("total_bytes"),
        F.max("day").alias("last_day"),
        F.max("_full").alias("full_day"),
        F.min(F.when(trailing, F.col("day"))).alias("empty_since"),
    )


def fold_state(state: DataFrame, days: DataFrame, keys: list[str] = SERIES) -> DataFrame:
    """The state after further days, all of them later than those that ``state`` has seen.

    A series has one row of the state and one of the new days, so one aggregate merges them: the work of a day grows
    with the series and the day's files, not with the days before.
    """
    both = state.select(*keys, *STATE).unionByName(size_state(days, keys).select(*keys, *STATE))
    merged = both.groupBy(*keys).agg(
        F.sum("total_bytes").alias("total_bytes"),
        F.max("last_day").alias("last_day"),
        F.max("full_day").alias("full_day"),
        F.min("empty_since").alias("_first"),
        F.max("empty_since").alias("_second"),
    )
    after = lambda c: F.col("full_day").isNull() | (F.col(c) > F.col("full_day"))
    since = F.when(after("_first"), F.col("_first")).when(after("_second"), F.col("_second"))
    return merged.withColumn("empty_since", since).select(*keys, *STATE)


def state_status(state: DataFrame, today: DataFrame, as_of, keys: list[str] = SERIES) -> DataFrame:
    """Per series: bytes of the day (from ``today``, its rows by series and day), bytes so far, and whether data was cut
    off or its task stopped."""
    of_day = today.where(F.col("day") == as_date(as_of)).groupBy(*keys).agg(F.sum("bytes").alias("file_bytes"))
    found = state.join(of_day, keys, "left").withColumn("file_bytes", F.coalesce("file_bytes", F.lit(0).cast("long")))
    return found.withColumn("status", _gap_label(as_of))


def _gap_label(as_of) -> Column:
    return (
        F.when(F.col("file_bytes") > 0, "normal")
        .when(F.col("empty_since").isNotNull(), _age_status("CutOff", F.col("empty_since"), as_of))
        .when(F.col("last_day") < as_date(as_of), _age_status("TaskStop", F.col("last_day"), as_of))
        .otherwise("normal")
    )


def gap_status(days: DataFrame, as_of, keys: list[str] = SERIES) -> DataFrame:
    """Per series: bytes of the day, bytes so far, and whether data was cut off or its task stopped.

    The trailing run of empty partitions starts at the first empty day after the last full one. All days up to the
    as-of day are read; ``fold_state`` gives the same from a stored state and the new days alone.
    """
    known = days.where(F.col("day") <= as_date(as_of))
    bytes_now = F.when(F.col("day") == as_date(as_of), F.col("bytes")).otherwise(0)
    series = Window.partitionBy(*keys)
    known = known.withColumn("file_bytes", F.sum(bytes_now).over(series))
    found = size_state(known, [*keys, "file_bytes"])
    return found.withColumn("status", _gap_label(as_of))


def full_table_freshness(
    files: DataFrame, as_of, keys: list[str] = SERIES, clock: str = "09:00"
) -> DataFrame:
    """Unpartitioned tables: bytes, and the age of the latest file as a status."""
    found = files.groupBy(*keys).agg(
        F.sum("length").alias("file_bytes"), F.max("modificationTime").alias("written")
    )
    age = F.datediff(as_date(as_of), F.to_date("written"))
    early = F.date_format("written", "HH:mm") <= clock
    status = (
        F.when(age >= 100, "CutOff100+Days")
        .when((age > 0) | ((age == 0) & early), age_label("CutOff", age, age + 1, 100))
        .otherwise("normal")
    )
    return found.withColumn("status", status)


def daily_sizes(
    files: DataFrame,
    inventory: DataFrame,
    as_of,
    registry: DataFrame | None = None,
    gaps: DataFrame | None = None,
) -> DataFrame:
    """Every inventory row with its bytes on the day, its total and its status.

    ``gaps`` is the status by series where it is known from a stored state; ``files`` then only needs the day's files
    and those without a day.

    Files without a valid day make a further row of their series, with a status of its own.
    Both measurements are one row per series before they meet the inventory, whose rows are
    distinct, so the joins have no hot keys.
    """
    gaps = gap_status(day_bytes(files, registry), as_of) if gaps is None else gaps
    gaps = gaps.select(
        *SERIES, F.col("file_bytes").alias("_day_bytes"), "total_bytes", "empty_since",
        F.col("status").alias("_gap"),
    )
    whole = full_table_freshness(files, as_of).select(
        *SERIES, F.col("file_bytes").alias("_whole_bytes"), F.col("status").alias("_fresh")
    )
    export = F.col("source_kind") == "db_export"
    keys = F.coalesce(F.col("partition_keys"), F.lit(""))
    unpartitioned = export & (keys == "")
    monthly = export & keys.contains("mon")
    measured = is_measured("status") | (F.col("source_kind") == "raw_log")
    bytes_now = F.coalesce(
        F.when(measured & unpartitioned, F.col("_whole_bytes")).when(
            measured & ~monthly, F.col("_day_bytes")
        ),
        F.lit(0).cast("long"),
    )
    status = (
        F.when(~measured, F.col("status"))
        .when(unpartitioned, F.coalesce("_fresh", F.lit("PartitionNotExists")))
        .when(monthly, "MonthPartition")
        .otherwise(F.coalesce("_gap", F.lit("PartitionNotExists")))
    )
    shown_day = F.when(F.col("file_bytes") > 0, as_date(as_of)).otherwise(F.col("empty_since"))
    path = F.when(
        measured & ~unpartitioned & ~monthly & shown_day.isNotNull(),
        F.concat(F.col("path"), F.lit("/day="), shown_day.cast("string")),
    ).otherwise(F.col("path"))
    total = F.when(
        F.col("source_kind") == "shared_event", F.coalesce("total_bytes", F.lit(0).cast("long"))
    ).otherwise(F.col("table_bytes"))
    joined = (
        inventory.join(gaps, SERIES, "left")
        .join(whole, SERIES, "left")
        .withColumn("file_bytes", bytes_now)
        .withColumn("_path", path)
    )
    measured_rows = joined.select(
        *SERIES, "source_kind", F.col("_path").alias("path"), "file_bytes", status.alias("status"),
        total.alias("table_bytes"), "queries", "partition_keys", as_date(as_of).alias("day"),
    )
    lost = _without_day(files, inventory).withColumn("day", as_date(as_of))
    return measured_rows.unionByName(lost.select(*measured_rows.columns))


def partition_path(
    path: str, day: Column, hour: Column, event_id: str = "event_id", keys: str = "partition_keys"
) -> Column:
    """Directory a measurement belongs to, as far down as the table is partitioned."""
    parts = F.coalesce(F.col(keys), F.lit(""))
    return F.concat_ws(
        "/",
        F.col(path),
        F.when(parts.contains("day"), F.concat(F.lit("day="), day.cast("string"))),
        F.when(parts.contains("hour"), F.concat(F.lit("hour="), F.format_string("%02d", hour))),
        F.when(parts.contains("event_id"), F.concat(F.lit("event_id="), F.col(event_id))),
    )


def hourly_sizes(
    files: DataFrame,
    inventory: DataFrame,
    day,
    hour: int,
    registry: DataFrame | None = None,
) -> DataFrame:
    """Every inventory row (exports aside) with its bytes in one hour.

    Tables without an hour partition count files by the hour they were written. A table that
    delivered keeps no earlier complaint; raw logs without any file that day take their gap status.
    Files without a valid day make a further row of their series, with a status of its own.
    """
    live = inventory.where(F.col("source_kind") != "db_export")
    keys = F.coalesce(F.col("partition_keys"), F.lit(""))
    today = files.where(F.col("day") == as_date(day))
    by_hour = today.groupBy(*SERIES).agg(
        F.sum(F.when(F.col("hour") == hour, F.col("length"))).alias("_part_bytes"),
        F.sum(F.when(F.hour("modificationTime") == hour, F.col("length"))).alias("_mtime_bytes"),
        F.count("*").alias("_files"),
    )
    gaps = gap_status(day_bytes(files, registry), day).select(*SERIES, F.col("status").alias("_gap"))
    raw = F.col("source_kind") == "raw_log"
    measured = is_measured("status") | raw
    timed = raw | ((F.col("source_kind") == "event") & ~keys.contains("hour"))
    bytes_now = F.coalesce(
        F.when(measured, F.when(timed, F.col("_mtime_bytes")).otherwise(F.col("_part_bytes"))),
        F.lit(0).cast("long"),
    )
    status = (
        F.when(~measured, F.col("status"))
        .when((F.col("file_bytes") > 0) | (raw & (F.col("_files") > 0)), "normal")
        .when(raw, F.coalesce("_gap", F.lit("PartitionNotExists")))
        .otherwise(F.col("status"))
    )
    joined = (
        live.join(by_hour, SERIES, "left").join(gaps, SERIES, "left").withColumn("file_bytes", bytes_now)
    )
    path = F.when(measured, partition_path("path", as_date(day), F.lit(hour))).otherwise(F.col("path"))
    measured_rows = joined.select(
        *SERIES, "source_kind", path.alias("path"), "file_bytes", status.alias("status"),
        "table_bytes", "queries", "partition_keys", as_date(day).alias("day"), F.lit(hour).alias("hour"),
    )
    lost = _without_day(files, live).withColumn("day", as_date(day)).withColumn("hour", F.lit(hour))
    return measured_rows.unionByName(lost.select(*measured_rows.columns))


def cutoff_table(daily: DataFrame) -> DataFrame:
    """Everything that is not normal, under its series name."""
    return daily.where(F.col("status") != "normal").select(
        series_name().alias("name"), "source_kind", "status", "table_bytes", "queries",
        "partition_keys", "day",
    )
