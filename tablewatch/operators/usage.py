"""Who reads what: path audits and statement audits."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import as_date
from ..functions.text import sql_tokens
from ..sources.tables import days_between
from .joins import within, without


def audit_reads(audit: DataFrame, root: str) -> DataFrame:
    """Distinct (directory, application) pairs of an audit log below ``root``."""
    app = F.regexp_extract("proto", "application_([0-9]+_[0-9]+)", 1)
    return (
        audit.where(F.col("src").contains(root) & F.col("proto").contains("application_"))
        .select(
            F.substring_index("src", "/day=", 1).alias("directory"),
            F.concat(F.lit("application_"), app).alias("app_id"),
        )
        .distinct()
    )


def _of_users(apps: DataFrame, users: Iterable[str]) -> DataFrame:
    """Applications of some users; a frame that does not say whose they are counts whole."""
    wanted = list(users)
    return apps.where(F.col("user").isin(wanted)) if wanted and "user" in apps.columns else apps


def usage_by_table(
    hot: DataFrame, cold: DataFrame, excluded: Iterable[DataFrame], as_of, root: str, users: Iterable[str] = ()
) -> DataFrame:
    """Applications per table directory on the day before, excluded applications aside.

    With ``users``, only these users' applications are excluded.

    Pairs are made distinct by partial aggregation first, so a directory read by everything
    shuffles each application once; the distinct count spreads over (name, application).
    """
    day = as_date(as_of)
    reads = audit_reads(days_between(hot, F.date_sub(day, 1), F.date_sub(day, 1)), root).unionByName(
        audit_reads(days_between(cold, F.date_sub(day, 1), day), root)
    )
    for apps in excluded:
        reads = without(reads, days_between(_of_users(apps, users), F.date_sub(day, 1), day), ["app_id"])
    return (
        reads.withColumn("name", F.element_at(F.split("directory", "/"), -1))
        .groupBy("name")
        .agg(F.countDistinct("app_id").alias("queries"))
    )


def usage_bitmaps(audit: DataFrame, root: str) -> DataFrame:
    """(name, day, cluster, bucket, apps): the applications that read a table on a day, as bitmaps of their numbers.

    An application is the start of its cluster and a number; leading zeros tell none apart. A bitmap holds the numbers
    of one bucket, so rows are small however many applications there are, and merge without the applications.
    """
    app = lambda i: F.regexp_extract("proto", "application_([0-9]+)_([0-9]+)", i).try_cast("long")
    reads = audit.where(F.col("src").contains(root)).select(
        F.element_at(F.split(F.substring_index("src", "/day=", 1), "/"), -1).alias("name"),
        "day", app(1).alias("cluster"), app(2).alias("_app"),
    ).where("_app is not null")
    bucket = F.bitmap_bucket_number("_app").alias("bucket")
    return reads.groupBy("name", "day", "cluster", bucket).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_app")).alias("apps")
    )


def usage_windows(bitmaps: DataFrame, as_of, lengths: Iterable[int] = (1, 2)) -> DataFrame:
    """(name, day, days, queries): distinct applications of the ``days`` days that end on each day.

    ``bitmaps`` as ``usage_bitmaps`` gives them, stored day by day or not: a day counts for itself and for the windows
    that end after it, so every length comes from one aggregate. Windows end on the as-of day or before.
    """
    pairs = [F.struct(F.lit(n).alias("days"), F.lit(i).alias("after")) for n in lengths for i in range(n)]
    ends = F.explode(F.array(*pairs))
    spread = bitmaps.withColumn("_w", ends).select(
        "name", "cluster", "bucket", "apps", F.date_add("day", F.col("_w.after")).alias("day"), "_w.days"
    )
    spread = spread.where(F.col("day") <= as_date(as_of))
    merged = spread.groupBy("name", "day", "days", "cluster", "bucket").agg(F.bitmap_or_agg("apps").alias("apps"))
    return merged.groupBy("name", "day", "days").agg(F.sum(F.bitmap_count("apps")).alias("queries"))


def recent_active(sizes: DataFrame, as_of, days: int = 11, min_queries: int = 1) -> DataFrame:
    """Raw logs read more than ``min_queries`` times on some day of the last ``days``."""
    day = as_date(as_of)
    return (
        days_between(sizes, F.date_sub(day, days), F.date_sub(day, 1))
        .where((F.col("source_kind") == "raw_log") & (F.col("queries") > min_queries))
        .select("name")
        .distinct()
    )


def mentioned_tables(
    statements: DataFrame, candidates: DataFrame, as_of, skip_users: Iterable[str] = ()
) -> DataFrame:
    """Candidate tables named in statements that finished the day before.

    Tokens are deduplicated per statement and then per task before any shuffle, so a token in every
    statement is no hot key. While the candidates are small enough to broadcast, the optimizer moves
    the semi join below the deduplication and only candidate names are shuffled.
    """
    day = F.date_sub(as_date(as_of), 1)
    kept = days_between(statements, day, day).where(F.col("job_state") == "FINISHED")
    skip = list(skip_users)
    if skip:
        kept = kept.where(~F.col("user_name").isin(skip))
    tokens = kept.select(F.explode(sql_tokens("query")).alias("name")).where(F.col("name") != "")
    return within(tokens.distinct(), candidates, ["name"])


def prefer_source(rows: DataFrame) -> DataFrame:
    """One row per table, the highest ``prefer`` first, ties by application and source.

    ``max_by`` keeps one row per table on the map side; a ranking window would move them all.
    """
    keep = F.struct("app_name", "table_source")
    order = F.struct(F.col("prefer"), F.col("app_name"), F.col("table_source"))
    return (
        rows.groupBy("name")
        .agg(F.max_by(keep, order).alias("_best"))
        .select("_best.app_name", "name", "_best.table_source")
    )


def monitored_tables(mentions: DataFrame, business: DataFrame, whitelist: DataFrame) -> DataFrame:
    """Mentioned tables and business tables, whitelisted names aside; the business row wins."""
    found = mentions.select(
        F.lit("dw").alias("app_name"), "name", F.lit("dw").alias("table_source"), F.lit(1).alias("prefer")
    )
    listed = business.select("app_name", "name", "table_source", F.lit(2).alias("prefer"))
    return prefer_source(without(found.unionByName(listed), whitelist, ["name"]))
