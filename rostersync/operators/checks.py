"""Column checks: each returns the violating rows; no rows means the check passes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class CheckFailed(AssertionError):
    """A check found violations."""


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count. NULLs are not compared."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where the column is NULL."""
    return df.where(F.col(column).isNull())


def require_empty(violations: DataFrame, what: str) -> None:
    """Raise when a check returned rows, naming a few of them."""
    found = violations.limit(5).collect()
    if found:
        raise CheckFailed(f"{what}: {[r.asDict() for r in found]}")
