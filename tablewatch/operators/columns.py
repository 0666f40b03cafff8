"""Columns of the monitored tables: catalog, owners, classes."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.names import _c
from ..functions.rules import as_date, epoch_ms_clock, epoch_ms_date, is_fresh, run_flag

NUMERIC = ("float", "int", "bigint", "double")


@dataclass(frozen=True)
class ClassRule:
    """One line of the classification table: any name test, and every other test, must hold."""

    column_class: str
    names: tuple[str, ...] = ()
    pattern: str = ""
    not_names: tuple[str, ...] = ()
    types: tuple[str, ...] = ()
    not_types: tuple[str, ...] = ()
    type_pattern: str = ""
    not_apps: tuple[str, ...] = ()


# How column names and types are read. The first matching line decides.
TIME_WORDS = (
    "timestamp|start_time|starttime|create_time|end_time|enter_time|exit_time|update_time|rtime|ctime"
    "|update_rtime|date_time|datetime|time_zone|event_time|param|reserve"
)
MEASURE_WORDS = (
    "dau|mau|pv|uv|pcu|pcr|acu|arpu|arppu|re[1-9]|re_[1-9]|[1-9]re|rr[1-9]|mr[1-9]|afr[1-9]|nfr[1-9]"
    "|retian[1-9]|remain_[1-9]|amount|amt|cnt|num|sum|avg|count|rate|ratio|percentage"
    "|users|people|fans|orders|_order|rooms|change|pay|commission|price|prize|cost|recharge|revenue"
    "|premium|_goal|income|dollar|money|diamond|bean|balance|ticket|duration|stay_time|watch|_day"
    "|_0[1-9]|d[0-9]|day[0-9]|data[0-9]|_vv|official_all"
)
DEFAULT_RULES = (
    ClassRule("not_monitor", pattern="day$", types=("string",)),
    ClassRule("not_monitor", names=("days", "time"), pattern=TIME_WORDS),
    ClassRule("not_monitor", type_pattern="array|map|struct"),
    ClassRule(
        "main_dimension",
        names=("os", "fin_region", "region", "area", "op_area", "app", "app_name"),
        types=("string",),
        not_apps=("dw",),
    ),
    ClassRule("uid", names=("user_id", "owner_id", "author_id", "creator", "uid64")),
    ClassRule("uid", pattern="uid$", not_names=("guid",)),
    ClassRule("string_id", pattern="id$", types=("string",)),
    ClassRule("num_id", pattern="id$", not_types=("string",)),
    ClassRule("values", pattern=MEASURE_WORDS + "|stay_time$|staytime$|times$", types=NUMERIC),
    ClassRule("attributes"),
)


def _rule_column(rule: ClassRule, name: Column, kind: Column, app: Column) -> Column:
    tests = []
    any_name = []
    if rule.names:
        any_name.append(name.isin(*rule.names))
    if rule.pattern:
        any_name.append(name.rlike(rule.pattern))
    if any_name:
        tests.append(any_name[0] if len(any_name) == 1 else any_name[0] | any_name[1])
    if rule.not_names:
        tests.append(~name.isin(*rule.not_names))
    if rule.types:
        tests.append(kind.isin(*rule.types))
    if rule.not_types:
        tests.append(~kind.isin(*rule.not_types))
    if rule.type_pattern:
        tests.append(kind.rlike(rule.type_pattern))
    if rule.not_apps:
        tests.append(~app.isin(*rule.not_apps))
    out = F.lit(True)
    for test in tests:
        out = out & test
    return out


def column_class(
    name: str | Column = "column_name",
    kind: str | Column = "column_type",
    app: str | Column = "app_name",
    rules: tuple[ClassRule, ...] = DEFAULT_RULES,
) -> Column:
    """Class of a catalog column as an expression."""
    name, kind, app = _c(name), _c(kind), _c(app)
    out = F
    for rule in rules:
        out = out.when(_rule_column(rule, name, kind, app), rule.column_class)
    return out


def _rule_holds(rule: ClassRule, name: str, kind: str, app: str) -> bool:
    named = not (rule.names or rule.pattern) or name in rule.names
    if not named and rule.pattern:
        named = re.search(rule.pattern, name) is not None
    return (
        named
        and name not in rule.not_names
        and (not rule.types or kind in rule.types)
        and kind not in rule.not_types
        and re.search(rule.type_pattern, kind) is not None
        and app not in rule.not_apps
    )


def classify_schema(
    schema: StructType,
    app: str = "",
    rules: tuple[ClassRule, ...] = DEFAULT_RULES,
    skip: tuple[str, ...] = (),
) -> dict[str, str]:
    """Class per column of a DataFrame's own schema, without any job."""
    out = {}
    for f in schema.fields:
        if f.name not in skip:
            kind = f.dataType.simpleString()
            out[f.name] = next(
                r.column_class for r in rules if _rule_holds(r, f.name, kind, app)
            )
    return out


@dataclass(frozen=True)
class TableProfile:
    """Column classes of one table, as the profile needs them."""

    classes: dict[str, str]
    dims: list[str] = field(default_factory=list)


def table_profile(schema: StructType, app: str = "", skip: tuple[str, ...] = ()) -> TableProfile:
    classes = classify_schema(schema, app, skip=skip)
    return TableProfile(classes, sorted(c for c, k in classes.items() if k == "main_dimension"))


CLASSES = ("uid", "string_id", "num_id", "main_dimension", "not_monitor", "values", "attributes")


def column_sets(catalog: DataFrame, keys: tuple[str, ...] = ("app_name", "name")) -> DataFrame:
    """Per table one sorted list of columns for every class; lists are as long as the schema is wide."""
    classed = catalog.withColumn("column_class", column_class())
    lists = [
        F.array_sort(F.collect_set(F.when(F.col("column_class") == c, F.col("column_name")))).alias(c)
        for c in CLASSES
    ]
    return classed.groupBy(*keys).agg(*lists)


# Attributes a table carries from the column catalog into its profile.
TABLE_ATTRIBUTES = (
    "app_name", "name", "owner", "partition_keys", "table_bytes", "update_clock", "queries",
    "day_bytes", "downstream",
)


def profile_config(catalog: DataFrame, run: str | None = None) -> DataFrame:
    """One row per table with its attributes, its columns by class, its run and, if the catalog has it, the day to
    read, smallest first."""
    keys = (*TABLE_ATTRIBUTES, *(c for c in ("read_day",) if c in catalog.columns))
    config = column_sets(catalog, keys).withColumn("run_flag", run_flag())
    if run is not None:
        config = config.where(F.col("run_flag") == run)
    return config.orderBy("day_bytes", "name")


def _fresh_edges(edges: DataFrame, as_of, max_age: int) -> DataFrame:
    return edges.where(
        (F.col("depth") == 1)
        & F.col("updated_ms").isNotNull()
        & (F.col("updated_ms") != 0)
        & is_fresh(epoch_ms_date("updated_ms"), as_of, max_age)
    )


def downstream_owners(edges: DataFrame, as_of, max_age: int = 2) -> DataFrame:
    """Distinct owners one step downstream, as sorted text.

    Pairs are made distinct first (combined on the map side), so the list that is collected per
    table is bounded by the number of people.
    """
    owners = (
        _fresh_edges(edges, as_of, max_age)
        .where(F.coalesce(F.col("owner"), F.lit("")) != "")
        .select("name", F.lower("owner").alias("owner"))
        .distinct()
    )
    return owners.groupBy("name").agg(
        F.concat_ws(",", F.array_sort(F.collect_list("owner"))).alias("downstream")
    )


def downstream_count(edges: DataFrame, as_of, max_age: int = 2) -> DataFrame:
    """Number of distinct tables one step downstream."""
    return (
        _fresh_edges(edges, as_of, max_age)
        .where(F.coalesce(F.col("target_name"), F.lit("")) != "")
        .groupBy("name")
        .agg(F.countDistinct("target_name").alias("downstream_tables"))
    )


def avg_day_bytes(
    tables: DataFrame, trend: DataFrame, day_sizes: DataFrame, as_of, days: int = 7
) -> DataFrame:
    """Average partition size of the last days; else yesterday's bytes; else the whole table.

    ``tables`` has ``name, table_bytes, partition_keys``; ``day_sizes`` has ``name, day, bytes``.
    """
    day = as_date(as_of)
    recent = (
        trend.where(F.col("day").between(F.date_sub(day, days), day))
        .groupBy("name")
        .agg(F.sum("bytes").alias("_sum"), F.count("*").alias("_n"))
    )
    yesterday = (
        day_sizes.where(F.col("day") == F.date_sub(day, 1))
        .groupBy("name")
        .agg(F.sum("bytes").alias("_yesterday"))
    )
    by_day = F.coalesce(F.col("partition_keys"), F.lit("")).contains("day")
    listed = F.when(by_day, F.coalesce("_yesterday", F.lit(0).cast("long"))).otherwise(F.col("table_bytes"))
    mean = F.floor(F.col("_sum") / F.col("_n")).cast("long")
    return (
        tables.join(recent, "name", "left")
        .join(yesterday, "name", "left")
        .select(*tables.columns, F.when(F.col("_n") > 0, mean).otherwise(listed).alias("day_bytes"))
    )


def latest_partition(day_sizes: DataFrame, as_of, days: int = 31) -> DataFrame:
    """Latest partition of each table in the last ``days``."""
    day = as_date(as_of)
    return (
        day_sizes.where(F.col("day").between(F.date_sub(day, days), day))
        .groupBy("name")
        .agg(F.max("day").alias("last_day"))
    )


def effective_day(tables: DataFrame, day_sizes: DataFrame, as_of) -> DataFrame:
    """Day to profile: the as-of day for tables updated by the next day, one day earlier for slower ones."""
    day = as_date(as_of)
    late = F.datediff(day, F.col("last_day")) > 1
    read_day = F.when((F.col("partition_keys") == "day") & late, F.date_sub(day, 1)).otherwise(day)
    return (
        tables.join(latest_partition(day_sizes, as_of), "name", "left")
        .select(*tables.columns, read_day.alias("read_day"))
    )


def column_catalog(
    tables: DataFrame,
    catalog: DataFrame,
    columns: DataFrame,
    edges: DataFrame,
    trend: DataFrame,
    day_sizes: DataFrame,
    as_of,
    max_age: int = 2,
) -> DataFrame:
    """One row per column of every table worth profiling, with the table's attributes.

    All joins run on one row per table; the columns are joined last.
    """
    described = catalog.select(
        "name",
        F.coalesce(F.when(F.col("real_owner") != "", F.col("real_owner")), F.col("owner")).alias("owner"),
        epoch_ms_clock("updated_ms").alias("update_clock"),
        epoch_ms_date("updated_ms").alias("_updated"),
        F.lower(F.coalesce("partition_keys", F.lit(""))).alias("partition_keys"),
        F.col("bytes").alias("table_bytes"),
        F.col("queries"),
    )
    base = tables.join(described, "name").where(is_fresh("_updated", as_of, max_age)).drop("_updated")
    sized = effective_day(avg_day_bytes(base, trend, day_sizes, as_of), day_sizes, as_of)
    used = sized.join(downstream_owners(edges, as_of, max_age), "name", "left").withColumn(
        "downstream", F.coalesce("downstream", F.lit(""))
    )
    kept = used.where(
        ~((F.col("app_name") == "dw") & (F.col("downstream") == "")) & (F.col("day_bytes") > 0)
    )
    return kept.join(
        columns.select(
            "name", "column_name", "column_type",
            F.coalesce("column_comment", F.lit("")).alias("column_comment"),
        ),
        "name",
    ).withColumn("day", as_date(as_of))
