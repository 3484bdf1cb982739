"""Comparing two assignment relations: what to add, what to remove, what stands.

The pairwise answer depends, for each row, on whether *some* row of the same key on the other side
has another group, the same group or none. So the other side is first reduced to one row per key
(smallest group, largest group, any NULL) with map-side combine, and a key with many rows on both
sides never produces its pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostersync.operators.joins import HOT_ROWS, SALTS, attach, attach_many
from rostersync.operators.sets import union_all
from rostersync.operators.staging import materialise

KEY, VALUE, STATUS, STAMP = (
    "workday_employee_number",
    "looker_user_group",
    "user_group_status",
    "lst_updt_ts",
)


def _groups(df: DataFrame, key: str, value: str, *more: str) -> DataFrame:
    """The distinct (key, ``more``, group) of rows with a key; few columns, copies gone map-side."""
    return (
        df.where(F.col(key).isNotNull())
        .select(
            F.col(key).alias("__key"),
            *[F.col(c).alias(f"__{c}") for c in more],
            F.col(value).alias("__value"),
        )
        .distinct()
    )


def _extent(groups: DataFrame, *by: str) -> DataFrame:
    """Per key (and ``by``): smallest and largest group, and whether a row has none."""
    return (
        groups.groupBy(*by)
        .agg(
            F.min("__value").alias("__lo"),
            F.max("__value").alias("__hi"),
            F.bool_or(F.col("__value").isNull()).alias("__gap"),
        )
        .withColumn("__seen", F.lit(True))
    )


def _differs(value: str) -> Column:
    """The key is new, or some row of it has no group or another group. NULL groups differ from none."""
    return (
        F.col("__seen").isNull()
        | F.col("__gap")
        | (F.col(value) != F.col("__lo"))
        | (F.col(value) != F.col("__hi"))
    )


def _others(df: DataFrame, *used: str) -> list[str]:
    """Columns to spread NULL keys by: all but key, group and status. The answer holds them anyway."""
    return [c for c in df.columns if c not in used] or df.columns


def _added(current: DataFrame, previous: DataFrame, key: str, value: str, status: str) -> DataFrame:
    against = _extent(_groups(previous, key, value), "__key")
    kept = [c for c in current.columns if c != status]
    joined = attach(current, against, {key: "__key"}, spread_by=_others(current, key, value, status))
    return joined.where(_differs(value)).select(*kept, F.lit("add").alias(status))


def _removed(
    previous: DataFrame,
    current: DataFrame,
    key: str,
    value: str,
    status: str,
    stamp: str,
    staged: bool = False,
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Each previous row once per current stamp of its key, then once per status it has there.

    Its group stands where it is the smallest or the largest there. In between, which takes three
    groups at one key and stamp, a list of the groups in between tells.
    """
    at = f"__{stamp}"
    groups = _groups(current, key, value, stamp)
    if staged:
        groups = materialise(groups, "groups")
    extent = _extent(groups, "__key", at)
    inner = (
        groups.where(F.col("__value").isNotNull())
        .join(
            extent.select(F.col("__key").alias("__key2"), F.col(at).alias("__at2"), "__lo", "__hi"),
            (F.col("__key") == F.col("__key2")) & F.col(at).eqNullSafe(F.col("__at2")),
        )
        .where((F.col("__value") > F.col("__lo")) & (F.col("__value") < F.col("__hi")))
        .select("__key", at, "__value", F.lit(True).alias("__inner"))
    )
    if staged:
        inner = materialise(inner, "inner")
    spread_by = _others(previous, key, value, status, stamp)
    joined = attach_many(
        previous, extent, {key: "__key"}, hot_rows, salts, staged, spread_by, ["__key", at]
    )
    joined = attach(
        joined.withColumnRenamed(at, "__stamp"),
        inner.withColumnRenamed(at, "__stamp2"),
        {key: "__key", "__stamp": "__stamp2", value: "__value"},
        null_safe=["__stamp"],
        spread_by=spread_by,
    )
    own = F.col(value)
    holds = F.col("__seen") & (
        (own.isNull() & F.col("__hi").isNotNull())
        | (own == F.col("__lo"))
        | (own == F.col("__hi"))
        | F.coalesce("__inner", F.lit(False))
    )
    # True for gone, False for standing; a status may itself be NULL, so it is not what is listed.
    outcomes = F.array_compact(F.array(F.when(_differs(value), True), F.when(holds, False)))
    kept = [c for c in previous.columns if c not in (key, stamp, status)]
    return joined.withColumn("__gone", F.explode(outcomes)).select(
        *kept,
        F.when(F.col("__seen"), F.col(key)).alias(key),
        F.col("__stamp").alias(stamp),
        F.when(F.col("__gone"), "remove").otherwise(F.col(status)).alias(status),
    )


def diff_added(
    current: DataFrame, previous: DataFrame, key: str = KEY, value: str = VALUE, status: str = STATUS
) -> DataFrame:
    """Current rows that are new or differ from some previous row of their key, as ``add``.

    A current row without a group is only added when its key is new or lost its group before.
    """
    return _added(current, previous, key, value, status).distinct()


def diff_removed(
    previous: DataFrame,
    current: DataFrame,
    key: str = KEY,
    value: str = VALUE,
    status: str = STATUS,
    stamp: str = STAMP,
) -> DataFrame:
    """Previous rows, as ``remove`` or with their own status where they stand.

    Key and ``stamp`` come from the current side, NULL for keys that left it; a key with several
    current stamps gives one row per stamp, and may be both removed and standing. The answer of a key
    thus grows with its previous rows times its current stamps; ``reconcile(mode="set")`` does not.
    """
    out = _removed(previous, current, key, value, status, stamp)
    return out.select(*previous.columns).distinct()


def _as_sets(previous: DataFrame, current: DataFrame, key: str, value: str, status: str) -> DataFrame:
    """Compare (key, group) pairs as sets; rows without a group are no assignment."""
    columns = [*[c for c in current.columns if c != status], status]
    old, new = previous.where(F.col(value).isNotNull()), current.where(F.col(value).isNotNull())

    def pairs(df: DataFrame) -> DataFrame:
        return (
            df.where(F.col(key).isNotNull())
            .select(F.col(key).alias("__key"), F.col(value).alias("__value"))
            .distinct()
            .withColumn("__seen", F.lit(True))
        )

    both = {key: "__key", value: "__value"}
    gained = attach(new, pairs(old), both, spread_by=_others(new, key, value, status))
    gained = gained.where(F.col("__seen").isNull())
    mirror = attach(old, pairs(new), both, spread_by=_others(old, key, value, status)).withColumn(
        status, F.when(F.col("__seen"), F.col(status)).otherwise("remove")
    )
    return union_all(gained.withColumn(status, F.lit("add")).select(*columns), mirror.select(*columns))


def reconcile_rows(
    previous: DataFrame,
    current: DataFrame,
    key: str = KEY,
    value: str = VALUE,
    status: str = STATUS,
    stamp: str = STAMP,
    mode: str = "pairwise",
    staged: bool = False,
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """``reconcile`` before duplicates are removed, for callers that remove them later anyway.

    ``staged`` writes down the narrow lists of current groups that several joins read.
    """
    if mode == "pairwise":
        columns = [*[c for c in current.columns if c != status], status]
        gone = _removed(previous, current, key, value, status, stamp, staged, hot_rows, salts)
        return union_all(
            _added(current, previous, key, value, status).select(*columns), gone.select(*columns)
        )
    if mode == "set":
        return _as_sets(previous, current, key, value, status)
    raise ValueError(f"mode must be 'pairwise' or 'set', not {mode!r}")


def trim_value(df: DataFrame, value: str = VALUE) -> DataFrame:
    return df.withColumn(value, F.trim(value))


def reconcile(
    previous: DataFrame,
    current: DataFrame,
    key: str = KEY,
    value: str = VALUE,
    status: str = STATUS,
    stamp: str = STAMP,
    mode: str = "pairwise",
    staged: bool = False,
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Added, removed and standing rows, each once, with the group trimmed afterwards.

    ``mode="pairwise"`` compares each row with every row of its key, so a person with several groups
    may be told to both add and remove one. ``mode="set"`` compares (key, group) pairs, which cannot
    contradict itself; there each row keeps its own side's key and stamp. ``staged`` as in
    ``reconcile_rows``.
    """
    rows = reconcile_rows(previous, current, key, value, status, stamp, mode, staged, hot_rows, salts)
    return trim_value(rows.distinct(), value)
