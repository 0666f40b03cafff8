"""Which tables to watch, and what the catalog and the audit logs say about them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import clean_name, keep_name, qualified_name, repair_location
from ..functions.rules import GIB, catalog_status, epoch_ms_date, is_fresh, is_warehouse_table


def export_tables(
    tasks: DataFrame, *, task_type: int, cluster: int, status: int, area: str
) -> DataFrame:
    """Running export tasks of one kind, cluster and area, with canonical names; what they are called is the site's."""
    return tasks.where(
        (F.col("task_type") == task_type)
        & (F.col("dest_cluster_id") == cluster)
        & (F.col("status") == status)
        & (F.col("area") == area)
        & (F.col("hive_db") != "tmp")
    ).withColumn("name", qualified_name("hive_db", "hive_table"))


def event_tables(configs: DataFrame) -> DataFrame:
    """Event streams that have a table of their own."""
    return configs.where((F.col("is_common") == 0) & (F.col("hive_table") != "")).withColumn(
        "name", clean_name("hive_table")
    )


def build_inventory(
    exports: DataFrame,
    events: DataFrame,
    shared: DataFrame,
    deny_schemas: Iterable[str] = (),
    deny_pattern: str | None = None,
) -> DataFrame:
    """Distinct ``(name, source_kind, event_id)`` of the three sources, filtered by name.

    The name filter runs below the deduplication, on the scans.
    """

    def tag(df: DataFrame, kind, event_id) -> DataFrame:
        return df.select(F.col("name"), kind.alias("source_kind"), event_id.alias("event_id"))

    rows = (
        tag(exports, F.lit("db_export"), F.lit(""))
        .unionByName(tag(events, F.lit("event"), F.lit("")))
        .unionByName(tag(shared, F.col("source_kind"), F.col("event_id").cast("string")))
    )
    return rows.where(keep_name("name", deny_schemas, deny_pattern)).distinct()


def attach_status(inventory: DataFrame, catalog: DataFrame, as_of) -> DataFrame:
    """Inventory rows with catalog size, usage, repaired path and status.

    The catalog has one row per table. Tables it does not know are ``NotFound``.
    """
    known = catalog.select(
        "name",
        F.col("guid"),
        F.col("bytes").alias("table_bytes"),
        F.col("queries"),
        epoch_ms_date("updated_ms").alias("_updated"),
        F.col("location"),
        F.col("partition_keys"),
    )
    bare_name = F.element_at(F.split("name", "\\."), -1)
    return inventory.join(known, "name", "left").select(
        "name", "event_id", "source_kind",
        repair_location("location", bare_name).alias("path"),
        catalog_status("guid", "table_bytes", "_updated", as_of).alias("status"),
        F.coalesce("table_bytes", F.lit(0).cast("long")).alias("table_bytes"),
        F.coalesce("queries", F.lit(0).cast("long")).alias("queries"),
        F.coalesce("partition_keys", F.lit("")).alias("partition_keys"),
    )


def admit_catalog(
    catalog: DataFrame, as_of, schema_pattern: str, temp_pattern: str = "temp|tmp", max_age: int = 2
) -> DataFrame:
    """Warehouse tables that hold data, are read, and were updated lately."""
    db = F.split_part("name", F.lit("."), F.lit(1))
    table = F.split_part("name", F.lit("."), F.lit(2))
    return catalog.where(
        is_warehouse_table(db, table, schema_pattern, temp_pattern)
        & (F.col("bytes") > 0)
        & (F.col("queries") > 0)
        & (F.col("updated_ms") > 0)
        & is_fresh(epoch_ms_date("updated_ms"), as_of, max_age)
    )


def merge_usage(usage: DataFrame, recent: DataFrame) -> DataFrame:
    """Today's usage, plus recently used tables with 0. Aggregated rather than joined."""
    quiet = recent.select("name", F.lit(0).cast("long").alias("queries"))
    return (
        usage.select("name", F.col("queries").cast("long"))
        .unionByName(quiet)
        .groupBy("name")
        .agg(F.max("queries").alias("queries"))
    )


def admit_by_usage(sizes: DataFrame, usage: DataFrame, min_bytes: int = 10 * GIB) -> DataFrame:
    """Tables in the usage list, and unused ones of at least ``min_bytes``."""
    joined = sizes.join(usage.select("name", F.col("queries").alias("_used")), "name", "left")
    return joined.where(F.col("_used").isNotNull() | (F.col("table_bytes") >= min_bytes)).select(
        *sizes.columns, F.coalesce("_used", F.lit(0).cast("long")).alias("queries")
    )


def raw_log_inventory(
    files: DataFrame, usage: DataFrame, root: str, min_bytes: int = 10 * GIB
) -> DataFrame:
    """Raw log directories as inventory rows."""
    sizes = files.groupBy("name").agg(F.sum("length").alias("table_bytes"))
    return admit_by_usage(sizes, usage, min_bytes).select(
        "name", F.lit("").alias("event_id"), F.lit("raw_log").alias("source_kind"),
        F.concat(F.lit(root.rstrip("/") + "/"), F.col("name")).alias("path"),
        F.lit("normal").alias("status"), "table_bytes", "queries", F.lit("day").alias("partition_keys"),
    )
