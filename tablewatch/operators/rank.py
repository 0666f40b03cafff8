"""Ranks over all rows of a result, without gathering them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ``monotonically_increasing_id`` holds the task above these bits and the row's place in it below.
_PLACE_BITS = 33


def ranked(df: DataFrame, order: list[Column], where: str, ranges: int | None = None) -> DataFrame:
    """The rows with their ``rank`` from 1 in an order, stored in the new folder ``where`` and read from there.

    One shuffle deals the rows by ranges of the order; each task sorts its range and numbers it. The stored numbers then
    need one offset for each range, and these counts are all that the driver sees. Rows that the order does not tell
    apart get different ranks, in any order. Without rows the result is empty.
    """
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    dealt = dealt.withColumn("_place", F.monotonically_increasing_id())
    dealt.write.parquet(where)
    stored = spark.read.schema(dealt.schema).parquet(where)
    stored = stored.withColumn("_range", F.shiftright("_place", _PLACE_BITS))
    starts, before = [], 0
    for found in sorted(stored.groupBy("_range").count().collect()):
        starts.append((found[0], before))
        before += found[1]
    offsets = spark.createDataFrame(starts, "_range long, _before long")
    inside = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    rank = F.col("_before") + inside + 1
    return stored.join(offsets, "_range").withColumn("rank", rank).drop("_place", "_range", "_before")
