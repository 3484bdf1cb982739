"""Ranks: dense ranks without a single task, and the latest rows per key with ties."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostersync.functions.ordering import descending, order_tuple
from rostersync.operators.staging import BROADCAST_ROWS, is_small, materialise

# Up to this many distinct values are ranked by a plain window.
WINDOW_VALUES = 100_000
# Low bits of a monotonically increasing identifier: the row's place in its partition.
PLACE_BITS = 33


def _null_safe(left: Sequence[str], right: Sequence[str]) -> Column:
    test = F.lit(True)
    for l, r in zip(left, right):
        test = test & F.col(l).eqNullSafe(F.col(r))
    return test


def _number_by_range(values: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Number sorted rows from 1: inside each range, plus the size of the ranges before it.

    A range is one sorted partition, so a row's place in it is the low part of the identifier that the
    sort's output is given there; no second exchange brings the rows of a range together.
    """
    # The ranges are cut from a sample, so another run may cut elsewhere: write the outcome down.
    placed = values.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    ranges = materialise(placed, "ranges").withColumns(
        {"__range": F.shiftright("__id", PLACE_BITS), "__place": F.col("__id").bitwiseAND((1 << PLACE_BITS) - 1)}
    )
    # One row per range, as many as there are shuffle partitions.
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranges.groupBy("__range")
        .agg(F.count("*").alias("__size"))
        .withColumn("__before", F.coalesce(F.sum("__size").over(before), F.lit(0)))
        .drop("__size")
    )
    return (
        ranges.join(F.broadcast(offsets), "__range")
        .withColumn(name, F.col("__place") + 1 + F.col("__before"))
        .drop("__range", "__before", "__id", "__place")
    )


def _dense_rank(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], nulls: str, name: str, strategy: str
) -> DataFrame:
    if strategy not in ("auto", "distinct", "range"):
        raise ValueError(f"unknown strategy {strategy!r}")
    key_cols = [f"__k{i}" for i in range(len(keys))]
    order_cols = [f"__o{i}" for i in range(len(order))]
    rows = df.withColumns(dict(zip(order_cols, order)))
    values = materialise(
        rows.select(*[F.col(k).alias(c) for k, c in zip(keys, key_cols)], *[F.col(c) for c in order_cols]).distinct(),
        "values",
    )
    found = values.count()
    few = found <= WINDOW_VALUES
    sort = descending([F.col(c) for c in order_cols], nulls)
    if few and strategy != "range":
        window = Window.partitionBy(*key_cols).orderBy(*sort)
        ranked = values.withColumn(name, F.row_number().over(window))
    else:
        ranked = _number_by_range(values, [*[F.col(c).asc_nulls_first() for c in key_cols], *sort], name)
        if keys:
            first = ranked.groupBy(*[F.col(c).alias(f"{c}f") for c in key_cols]).agg(F.min(name).alias("__first"))
            ranked = ranked.join(first, _null_safe(key_cols, [f"{c}f" for c in key_cols])).withColumn(
                name, F.col(name) - F.col("__first") + 1
            )
    side = ranked.select(
        *key_cols, *[F.col(c).alias(f"{c}v") for c in order_cols], F.col(name).cast("long").alias(name)
    )
    test = _null_safe([*keys, *order_cols], [*key_cols, *[f"{c}v" for c in order_cols]])
    # The written values are as many and as wide as the side, less its rank, and cheap to measure.
    if found <= BROADCAST_ROWS and is_small(values):
        side = F.broadcast(side)
    return rows.join(side, test).select(*df.columns, name)


def global_dense_rank(
    df: DataFrame,
    order: Sequence[str],
    nulls: str = "first",
    name: str = "rnk",
    strategy: str = "auto",
) -> DataFrame:
    """Dense rank over the whole relation, largest first, as a long.

    Equal values share a rank, so ranking the distinct values is enough, and a value held by a third
    of all rows is one value after map-side combine. ``"auto"`` writes the distinct values down,
    counts them, and ranks them in one task (``"distinct"``) if there are few, else range by range
    (``"range"``).
    """
    return _dense_rank(df, [], [F.col(c) for c in order], nulls, name, strategy)


def rank_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    nulls: str = "first",
    name: str = "rnk",
    strategy: str = "auto",
) -> DataFrame:
    """Dense rank per key, largest first. A NULL key is a key like any other.

    Distinct (key, order) values are numbered as in ``global_dense_rank``, sorted by key first; the
    rank inside a key is the distance to its smallest number. So a hot key may span many ranges.
    """
    return _dense_rank(df, list(keys), list(order), nulls, name, strategy)


def flag_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    scopes: Mapping[str, Column | None],
    nulls: str = "first",
    staged: bool = False,
) -> DataFrame:
    """Add one boolean per scope: is the row among the latest of its key within that scope?

    A scope is a row condition, or None for all rows. The best order tuple of each key comes from
    an aggregate with map-side combine; only keys with two rows or more need comparing, so rows
    meet a side that is usually far smaller than the table. ``staged`` writes that side down first,
    which shows its size to the optimizer: small means no shuffle of ``df`` at all. Ties of a hot
    key are never gathered in one task.
    """
    within = {
        name: F.lit(True) if cond is None else F.coalesce(cond, F.lit(False))
        for name, cond in scopes.items()
    }
    rows = df.withColumn("__t", order_tuple(order, nulls))
    contested = (
        rows.groupBy(*[F.col(k).alias(f"__key_{k}") for k in keys])
        .agg(
            F.count("*").alias("__n"),
            *[F.max(F.when(cond, F.col("__t"))).alias(f"__best_{name}") for name, cond in within.items()],
        )
        .where(F.col("__n") > 1)
    )
    if staged:
        contested = materialise(contested, "contested")
    joined = rows.join(contested, _null_safe(list(keys), [f"__key_{k}" for k in keys]), "left")
    flags = [
        (cond & (F.col("__n").isNull() | F.col("__t").eqNullSafe(F.col(f"__best_{name}")))).alias(name)
        for name, cond in within.items()
    ]
    return joined.select(*df.columns, *flags)


def latest_with_ties(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    nulls: str = "first",
    null_key: str = "rank",
    staged: bool = False,
) -> DataFrame:
    """Rows of rank 1 per key, ties kept.

    ``null_key="rank"`` ranks all rows with a NULL key together; ``"keep_all"`` keeps each of them.
    """
    if null_key not in ("rank", "keep_all"):
        raise ValueError(f"null_key must be 'rank' or 'keep_all', not {null_key!r}")
    best = F.col("__latest")
    if null_key == "keep_all":
        for k in keys:
            best = best | F.col(k).isNull()
    return flag_latest(df, keys, order, {"__latest": None}, nulls, staged).where(best).drop("__latest")
