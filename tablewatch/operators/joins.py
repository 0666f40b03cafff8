"""Join shapes shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 4


def without(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``other``; null keys in ``other`` match nothing."""
    return df.join(other.select(*on).dropna().distinct(), on, "left_anti")


def within(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``other``."""
    return df.join(other.select(*on).distinct(), on, "left_semi")


def spread_join(
    big: DataFrame, small: DataFrame, on: list[str], by: list[str], how: str = "left", salts: int = SALTS
) -> DataFrame:
    """Join where one key of ``big`` may hold a large part of its rows.

    ``small`` has one row per key. Its rows are repeated once per salt and the rows of ``big``
    spread over the salts by the hash of ``by`` (columns that vary inside a key), so a hot key is
    shared by ``salts`` tasks, and adaptive execution splits what is still too large for one. Few salts
    are enough where the key itself varies by day and metric; ``small`` is repeated for every key.
    """
    salt = F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int")
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return big.withColumn("_salt", salt).join(repeated, [*on, "_salt"], how).drop("_salt")
