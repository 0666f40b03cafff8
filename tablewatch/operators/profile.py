"""Column profiles: every metric of a table in one aggregate, then long form."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, IntegralType, NumericType, StringType
from pyspark.sql.types import StructType, TimestampNTZType, TimestampType

from ..functions.rules import as_date
from .columns import CLASSES, TableProfile, table_profile

DIMENSION, METRICS = "dimension", "metrics"


@dataclass(frozen=True)
class Metric:
    name: str
    metric_class: str
    expr: Column


def _rate(test: Column) -> Column:
    return F.round(F.try_divide(F.count_if(test) * F.lit(100.0), F.count(F.lit(1))), 2)


def _default_text(c: Column) -> Column:
    return c.isNull() | (c == "") | (F.lower(c) == "unknown")


def _not_positive(c: Column, kind: DataType) -> Column:
    """``c <= 0`` for any type: times compare with the epoch, types without order never match."""
    if isinstance(kind, NumericType):
        return c <= 0
    if isinstance(kind, BooleanType):
        return ~c
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return c <= F.lit("1970-01-01").cast(kind)
    return F.lit(False)


def _total(c: Column, kind: DataType) -> Column:
    """The sum of a measure; whole numbers add up as decimals, which no table is large enough to overflow."""
    return F.sum(c.cast("decimal(20,0)") if isinstance(kind, IntegralType) else c)


def column_metrics(name: str, column_class: str, kind: DataType) -> list[Metric]:
    """Metrics of one column, by class and type. Numeric results are exact or rounded."""
    c = F.col(name)
    text = isinstance(kind, StringType)

    def made(suffix: str, expr: Column) -> Metric:
        return Metric(name + suffix, column_class, expr.alias(name + suffix))

    if column_class == "uid":
        valid = F.coalesce(c.try_cast("bigint"), F.lit(0)) > 0
        return [made("_num_poly2", F.count_if(valid)), made("_rate_poly2", _rate(valid))]
    if column_class in ("string_id", "num_id"):
        missing = _default_text(c) if column_class == "string_id" else c.isNull() | _not_positive(c, kind)
        return [made("_num_poly3", F.count_if(missing)), made("_rate_poly3", _rate(missing))]
    if column_class == "values":
        total = _total(c, kind)
        mean = F.round(F.try_divide(total.cast("double"), F.count_if(c != 0)), 2)
        return [
            made("_sum_poly1", F.coalesce(total, F.lit(0))),
            made("_avg_poly1", F.coalesce(mean, F.lit(0.0))),
        ]
    if column_class == "attributes":
        return [made("_rate_poly3", _rate(_default_text(c) if text else _not_positive(c, kind)))]
    return []


def metrics_of(schema: StructType, classes: dict[str, str]) -> list[Metric]:
    kinds = {f.name: f.dataType for f in schema.fields}
    rows = Metric("row_num", "rows", F.count(F.lit(1)).alias("row_num"))
    return [rows] + [m for c, k in classes.items() for m in column_metrics(c, k, kinds[c])]


def profile(
    df: DataFrame,
    classes: dict[str, str],
    dims: list[str] | tuple[str, ...] = (),
    by: list[str] | tuple[str, ...] = (),
) -> DataFrame:
    """All metrics per dimension group in one pass (wide). ``by`` adds keys such as the day.

    Counts and sums combine on the map side, so the shuffle carries one row per task and group
    however rows are spread over the groups.
    """
    exprs = [m.expr for m in metrics_of(df.schema, classes)]
    return df.groupBy(*by, *sorted(dims)).agg(*exprs)


def dimension_key(dims: list[str] | tuple[str, ...]) -> Column:
    """``name:value,name:value`` with sorted names; null values are spelled out."""
    parts = [
        F.concat(F.lit(f"{d}:"), F.coalesce(F.col(d).cast("string"), F.lit("null"))) for d in sorted(dims)
    ]
    return F.concat_ws(",", *parts) if parts else F.lit("")


def melt(wide: DataFrame, metrics: list[Metric], dims=(), by=()) -> DataFrame:
    """Wide profile to ``(by..., dimension, metric, metric_class, value)``."""
    cells = F.array(
        *[
            F.struct(
                F.lit(m.name).alias("metric"),
                F.lit(m.metric_class).alias("metric_class"),
                F.col(m.name).cast("double").alias("value"),
            )
            for m in metrics
        ]
    )
    return wide.select(*by, dimension_key(dims).alias(DIMENSION), F.explode(cells).alias("_m")).select(
        *by, DIMENSION, "_m.metric", "_m.metric_class", "_m.value"
    )


def profile_long(
    df: DataFrame,
    classes: dict[str, str],
    dims: list[str] | tuple[str, ...] = (),
    by: list[str] | tuple[str, ...] = (),
    chunk: int = 80,
) -> DataFrame:
    """Long profile. Very wide tables are aggregated ``chunk`` columns at a time, each pass reading
    only its own columns, to keep the generated aggregate code compilable."""
    measured = [c for c in classes.items() if c[1] not in ("not_monitor", "main_dimension")]
    groups = [measured[i : i + chunk] for i in range(0, len(measured), chunk)] or [[]]
    parts = []
    for i, group in enumerate(groups):
        part = dict(group)
        metrics = metrics_of(df.schema, part)
        wide = profile(df, part, dims, by)
        parts.append(melt(wide, metrics if i == 0 else metrics[1:], dims, by))
    return reduce(DataFrame.unionByName, parts)


def profile_table(
    df: DataFrame, plan: TableProfile, as_of, read_day=None, day: str = "day", chunk: int = 80, empty: bool = True
) -> DataFrame:
    """Long profile of one table on one day. An empty day still gives ``row_num = 0``, unless ``empty`` is false: of a
    table with dimensions that takes a second, bare count, which ``empty_tables`` does without from stored rows.

    ``read_day`` is the partition to read where it differs from the as-of day; tables without a
    day column are read whole.
    """
    target = as_of if read_day is None else read_day
    rows = df.where(F.col(day) == as_date(target)) if day in df.columns else df
    out = profile_long(rows, plan.classes, plan.dims, (), chunk)
    if plan.dims and empty:
        none = rows.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == 0)
        out = out.unionByName(
            none.select(
                F.lit("").alias(DIMENSION), F.lit("row_num").alias("metric"),
                F.lit("rows").alias("metric_class"), F.lit(0.0).alias("value"),
            )
        )
    return out


# Columns of the metric history, in order; the last two are its partitions.
HISTORY_COLUMNS = (
    "app_name", "name", "owner", "partition_keys", "table_bytes", "queries", "day_bytes", "downstream",
    "dimension", "metric", "metric_class", "value", "day", "run_flag",
)


def profile_all(
    tables: dict[str, DataFrame],
    config: DataFrame,
    as_of,
    run: str,
    apps: dict[str, str] | None = None,
    read_days: dict[str, object] | None = None,
    partitions: dict[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """Metric rows of many tables for one run, ready for the (day, run_flag) partition.

    ``partitions`` names a table's partition columns besides ``day``; they are not profiled, all others are.
    ``tables`` maps names to data, ``config`` has one attribute row per table. The union is one
    job; Spark's scheduler interleaves its scans.
    """
    parts = []
    for name, df in tables.items():
        plan = table_profile(df.schema, (apps or {}).get(name, ""), skip=("day", *(partitions or {}).get(name, ())))
        read = (read_days or {}).get(name)
        parts.append(profile_table(df, plan, as_of, read).withColumn("name", F.lit(name)))
    return with_attributes(reduce(DataFrame.unionByName, parts), config, as_of, run)


@dataclass(frozen=True)
class RunPlan:
    """What a run does with one table."""

    profile: TableProfile
    read_day: object = None


def run_plans(
    tables: dict[str, DataFrame], config: DataFrame, run: str, partitions: dict[str, tuple[str, ...]] | None = None
) -> dict[str, RunPlan]:
    """Plans of the tables that the stored configuration puts into a run: classes, application and day to read.

    The configuration has one row per table; only the rows of ``tables`` come to the driver. Columns it does not have
    are made up for: without ``run_flag`` all tables are in the run, without lists of columns these are classified by
    the application's rules, without ``read_day`` the as-of day is read. Listed columns that a table lacks by now, its
    day and its ``partitions`` are not profiled.
    """
    known = config.where(F.col("name").isin(list(tables)))
    if "run_flag" in config.columns:
        known = known.where(F.col("run_flag") == run)
    plans = {}
    for row in known.collect():
        row, schema = row.asDict(), tables[row["name"]].schema
        skip = ("day", *(partitions or {}).get(row["name"], ()))
        listed = {c: k for k in CLASSES for c in row.get(k) or () if c in schema.names and c not in skip}
        if any(k in row for k in CLASSES):
            found = TableProfile(listed, sorted(c for c, k in listed.items() if k == "main_dimension"))
        else:
            found = table_profile(schema, row.get("app_name") or "", skip=skip)
        plans[row["name"]] = RunPlan(found, row.get("read_day"))
    return plans


def profile_planned(tables: dict[str, DataFrame], plans: dict[str, RunPlan], as_of) -> DataFrame:
    """Metric rows of planned tables, one scan for each; tables without rows on their day may have none."""
    parts = [
        profile_table(tables[name], plan.profile, as_of, plan.read_day, empty=False).withColumn("name", F.lit(name))
        for name, plan in plans.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def empty_tables(metrics: DataFrame, names: list[str]) -> DataFrame:
    """``row_num = 0`` for each of the names without a row. ``metrics`` is read once more, so it should be stored."""
    spark = metrics.sparkSession
    asked = spark.createDataFrame([(n,) for n in names], "name string")
    return asked.join(metrics.select("name").distinct(), "name", "left_anti").select(
        F.lit("").alias(DIMENSION), F.lit("row_num").alias("metric"), F.lit("rows").alias("metric_class"),
        F.lit(0.0).alias("value"), "name",
    )


def with_attributes(metrics: DataFrame, config: DataFrame, as_of, run: str) -> DataFrame:
    """Add table attributes (one row per table) and the partition the rows belong to."""
    keep = ["app_name", "owner", "partition_keys", "table_bytes", "queries", "day_bytes", "downstream"]
    day = as_date(as_of) if as_of is not None else F.col("day")
    return (
        metrics.join(config.select("name", *keep), "name")
        .withColumn("day", day)
        .withColumn("run_flag", F.lit(run))
        .select(*HISTORY_COLUMNS)
    )
