"""Set operations that check their columns first: Spark matches them by position."""

from __future__ import annotations

from pyspark.sql import DataFrame


def _same_columns(a: DataFrame, b: DataFrame) -> None:
    if a.columns != b.columns:
        raise ValueError(f"column lists differ: {a.columns} / {b.columns}")


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """All rows of both."""
    _same_columns(a, b)
    return a.union(b)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either, each once; NULLs count as equal."""
    return union_all(a, b).distinct()
