"""Partitioned tables and hand-kept lists."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions.rules import as_date


def read_table(
    spark: SparkSession, location: str, fmt: str = "orc", schema: StructType | str | None = None
) -> DataFrame:
    """A table by path (anything with a slash) or by catalog name."""
    if "/" not in location:
        return spark.table(location)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(location)


def days_between(df: DataFrame, day_from, day_to, column: str = "day") -> DataFrame:
    """Rows of a day range, bounds included. On a partition column this prunes directories.

    The column's type chooses the comparison. Text days (``2024-05-20``) are compared as text, which a metastore can
    prune and which no other text (``tmp``) breaks; texts that are no day of that form are in no range.
    """
    low, high = as_date(day_from), as_date(day_to)
    if isinstance(df.schema[column].dataType, StringType):
        written = F.length(column) == len("2024-05-20")
        return df.where(written & F.col(column).between(low.cast("string"), high.cast("string")))
    return df.where(F.col(column).between(low, high))


def read_days(
    spark: SparkSession,
    location: str,
    day_from,
    day_to,
    fmt: str = "orc",
    column: str = "day",
    schema: StructType | str | None = None,
) -> DataFrame:
    """Rows of a day range of a stored table; ``schema`` also fixes the type of its partition columns."""
    return days_between(read_table(spark, location, fmt, schema), day_from, day_to, column)


def read_list(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Comma-separated text lists with backslash escapes and a known schema.

    Such lists have no quotes, and Spark's CSV reader honours escapes inside quotes only, so lines
    are cut at unescaped commas here.
    """
    fields = F.split("value", "(?<!\\\\),")
    cells = [
        F.regexp_replace(F.get(fields, F.lit(i)), "\\\\(.)", "$1").try_cast(f.dataType).alias(f.name)
        for i, f in enumerate(schema.fields)
    ]
    return spark.read.text(path).select(*cells)


def _file_system(spark: SparkSession, path: str):
    """The file system of a path and the class of its paths."""
    paths = spark._jvm.org.apache.hadoop.fs.Path
    return paths(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), paths


def exists(spark: SparkSession, path: str) -> bool:
    fs, paths = _file_system(spark, path)
    return fs.exists(paths(path))


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that nothing reads any more."""
    fs, paths = _file_system(spark, path)
    fs.delete(paths(path), True)


def _switch(spark: SparkSession, staged: str, place: str) -> None:
    """Put a written folder in the place of another, which is kept aside until the new one stands there."""
    fs, path = _file_system(spark, place)
    aside = path(f"{staged}-before")
    fs.mkdirs(path(place).getParent())
    had = fs.exists(path(place)) and fs.rename(path(place), aside)
    if not fs.rename(path(staged), path(place)):
        if had:
            fs.rename(aside, path(place))
        raise OSError(f"could not put {staged} in place of {place}")
    if had:
        fs.delete(aside, True)


def _only(df: DataFrame, own: dict[str, object]) -> DataFrame:
    """The rows without their run's columns; a row of another run is an error.

    The test stands in a column, not in a filter, which could be moved below others and then see rows that those drop.
    """
    first, *rest = (f for f in df.schema if f.name not in own)
    value = F.col(f"`{first.name}`")
    for column, wanted in own.items():
        same = F.col(column).cast("string").eqNullSafe(F.lit(str(wanted)))
        other = F.raise_error(F.lit(f"a row is not of {column}={wanted}")).cast(first.dataType)
        value = F.when(same, value).otherwise(other)
    return df.select(value.alias(first.name), *(F.col(f"`{f.name}`") for f in rest))


def write_partitions(
    df: DataFrame,
    path: str,
    by: list[str],
    fmt: str = "orc",
    compression: str = "snappy",
    own: dict[str, object] | None = None,
) -> None:
    """Replace exactly the partitions present in ``df``; a rerun replaces its own output.

    ``own`` names the partition of the run by its leading columns, and all rows of ``df`` belong to it. The result is
    written beside the table first and then put in the partition's place, so a run that fails leaves the former rows,
    one without rows leaves none, and ``df`` may read what it replaces.

    The rebalance hint lets adaptive execution merge small and split large partitions, so one
    hot day neither lands in one task nor leaves thousands of tiny files.
    """
    mine = [c for c in by if c in (own or {})]
    if mine != by[: len(mine)] or len(mine) != len(own or {}):
        raise ValueError(f"{own} must name leading columns of {by}")
    rest = by[len(mine) :]
    writer = df.hint("rebalance", *[F.col(c) for c in by])
    if not own:
        writer = writer.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.option("compression", compression).partitionBy(*by).format(fmt).save(path)
        return
    root = path.rstrip("/")
    staged = f"{root}/_staged-{uuid.uuid4().hex}"
    _only(df.hint("rebalance", *[F.col(c) for c in rest]) if rest else df, {c: own[c] for c in mine}).write.option(
        "compression", compression
    ).partitionBy(*rest).format(fmt).save(staged)
    _switch(df.sparkSession, staged, "/".join([root, *(f"{c}={own[c]}" for c in mine)]))


def overwrite_table(df: DataFrame, table: str, own: dict[str, object] | None = None) -> None:
    """Replace partitions of a catalog table, columns matched by name.

    With ``own``, which names one partition whole, the rows are written to a new folder and the catalog's entry is
    then pointed at it: readers see the former rows or the new ones, a failed run changes nothing, and a run without
    rows leaves an empty partition. Without it the partitions present in ``df`` are replaced; catalog tables take the
    overwrite mode from the session only, so it is set for this write.
    """
    spark, mode = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    if own:
        about = {r.col_name: r.data_type for r in spark.sql(f"describe formatted {table}").collect()}
        staged = f"{about['Location'].rstrip('/')}/_runs/{uuid.uuid4().hex}"
        columns = [c for c in spark.table(table).columns if c not in own]
        _only(df, own).select(*columns).write.format(about["Provider"]).save(staged)
        spec = ", ".join(f"{c} = '{v}'" for c, v in own.items())
        spark.sql(f"alter table {table} add if not exists partition ({spec})")
        spark.sql(f"alter table {table} partition ({spec}) set location '{staged}'")
        spark.catalog.refreshTable(table)
        return
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        df.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(mode, before)
