"""Report lines: one text row per alert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import (
    first_users,
    fmt_bytes,
    fmt_file_bytes,
    interval_text,
    metric_label,
    ratio_text,
)


def metric_lines(anomalies: DataFrame) -> DataFrame:
    """Out-of-band series with attributes as readable columns, by application and table, last first."""
    weights = F.when(F.col("dimension") != "", F.concat(
        F.lit("rows: "), F.col("row_num").cast("long").cast("string"),
        F.lit(" ("), F.col("row_share").cast("string"), F.lit("%), share: "),
        F.col("value_share").cast("string"), F.lit("% (usually "),
        F.col("usual_value_share").cast("string"), F.lit("%)"),
    )).otherwise(F.concat(F.lit("rows: "), F.col("row_num").cast("long").cast("string")))
    return anomalies.select(
        "app_name", "name", "owner",
        fmt_bytes("table_bytes").alias("table_size"),
        "queries",
        first_users("downstream").alias("users"),
        "dimension", "metric",
        metric_label("metric").alias("label"),
        interval_text("metric", "value", "band_lo", "band_hi").alias("interval"),
        ratio_text("value", "centre").alias("ratio"),
        weights.alias("weight"),
    ).orderBy(F.desc("app_name"), F.desc("name"), "dimension", "metric")


def volume_lines(rows: DataFrame) -> DataFrame:
    """Volume alerts as readable columns, most used and largest first."""
    detail = F.coalesce(
        F.when(F.col("detail").rlike("^[0-9]+$"), fmt_file_bytes(F.col("detail").try_cast("bigint"))),
        F.col("detail"),
    )
    return rows.select(
        "name", "source_kind", fmt_bytes("table_bytes").alias("table_size"), "table_bytes", "queries",
        "path", detail.alias("detail"), "topic",
    ).orderBy(F.desc("queries"), F.desc("table_bytes"), "name", "topic")
