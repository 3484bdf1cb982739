"""Aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def single_valued(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with exactly one distinct value, and that value.

    Smallest equals largest says the same as counting distinct values, in one pass whose partial
    results are one row per key. NULL keys and values are left out.
    """
    return (
        df.where(F.col(key).isNotNull() & F.col(value).isNotNull())
        .groupBy(key)
        .agg(F.min(value).alias(value), F.max(value).alias("__most"))
        .where(F.col(value) == F.col("__most"))
        .drop("__most")
    )
