"""Descending order with a written-out place for NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NULLS = ("first", "last")


def _check(nulls: str) -> None:
    if nulls not in NULLS:
        raise ValueError(f"nulls must be one of {NULLS}, not {nulls!r}")


def descending(cols: Sequence[Column], nulls: str = "first") -> list[Column]:
    """Sort keys, largest first, NULL first or last."""
    _check(nulls)
    if nulls == "first":
        return [c.desc_nulls_first() for c in cols]
    return [c.desc_nulls_last() for c in cols]


def order_tuple(cols: Sequence[Column], nulls: str = "first") -> Column:
    """One struct whose maximum is the row that ``descending`` sorts to the front.

    A flag before each value gives NULL its place, so ``max`` (with map-side partial aggregation)
    can stand in for a sort.
    """
    _check(nulls)
    parts: list[Column] = []
    for i, c in enumerate(cols):
        flag = c.isNull() if nulls == "first" else c.isNotNull()
        parts += [flag.alias(f"f{i}"), c.alias(f"v{i}")]
    return F.struct(*parts)
