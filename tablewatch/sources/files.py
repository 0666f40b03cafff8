"""Partition files with size and age, without opening them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import in_progress, partition_value, strip_scheme, table_segment
from ..functions.rules import as_date


def describe_files(listing: DataFrame) -> DataFrame:
    """Add what a path says: table, day, hour and event id; unfinished files are left out.

    ``listing`` holds ``path, length, modificationTime``. Values that are no dates give a null day.
    """
    path = F.col("path")
    return (
        listing.where(~in_progress("path"))
        .select(strip_scheme("path").alias("path"), "length", "modificationTime")
        .select(
            table_segment(path).alias("name"),
            F.coalesce(partition_value(path, "event_id"), F.lit("")).alias("event_id"),
            F.try_to_date(partition_value(path, "day")).alias("day"),
            partition_value(path, "hour").try_cast("int").alias("hour"),
            "path",
            "length",
            "modificationTime",
        )
    )


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """One row per file under ``root`` (globs allowed).

    Only file status columns are selected, so the content column is pruned and no file is read.
    Spark's own listing runs as a job beyond
    ``spark.sql.sources.parallelPartitionDiscovery.threshold`` directories.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length", "modificationTime")
    )
    return describe_files(listing)


def stored_files(table: DataFrame) -> DataFrame:
    """One row per file of the rows of a stored table, with its number of rows, as ``describe_files`` shows them.

    Restrict the table to the days wanted before: the directories of other days are then never listed, and no column
    is read. Rows combine in the tasks that scan them, so the shuffle carries a row for each file. Files without rows
    do not show; ``expected_partitions`` tells what has none.
    """
    info = {"path": "file_path", "length": "file_size", "modificationTime": "file_modification_time"}
    files = table.groupBy(*(F.col(f"_metadata.{c}").alias(n) for n, c in info.items())).agg(F.count("*").alias("rows"))
    described = describe_files(files.drop("rows"))
    return described.join(files.select(strip_scheme("path").alias("path"), "rows"), "path")


def expected_partitions(tables: DataFrame, day_from, day_to, hourly: bool = False) -> DataFrame:
    """(name, day) or (name, day, hour) of every partition that the named tables should have in a range of days."""
    days = F.explode(F.sequence(as_date(day_from), as_date(day_to)))
    rows = tables.select("name").distinct().select("name", days.alias("day"))
    return rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")) if hourly else rows


def partition_gaps(files: DataFrame, tables: DataFrame, day_from, day_to, hourly: bool = False) -> DataFrame:
    """Expected partitions without bytes: ``empty`` where only files without bytes are there, ``absent`` without files.

    Neither the catalog nor a listing of directories is needed, so one job covers all tables.
    """
    keys = ["name", "day", *(["hour"] if hourly else [])]
    there = files.groupBy(*keys).agg(F.sum("length").alias("bytes"))
    asked = expected_partitions(tables, day_from, day_to, hourly)
    found = asked.join(there, keys, "left").where(F.coalesce("bytes", F.lit(0)) == 0)
    return found.select(*keys, F.when(F.col("bytes").isNull(), "absent").otherwise("empty").alias("gap"))


def partition_registry(spark: SparkSession, table: str, name: str | None = None) -> DataFrame:
    """Partitions the catalog knows, empty ones included, which no file listing shows."""
    path = F.concat(F.lit("/"), F.col("partition"))
    return spark.sql(f"SHOW PARTITIONS {table}").select(
        F.lit(name or table).alias("name"),
        F.coalesce(partition_value(path, "event_id"), F.lit("")).alias("event_id"),
        F.try_to_date(partition_value(path, "day")).alias("day"),
        partition_value(path, "hour").try_cast("int").alias("hour"),
    )
