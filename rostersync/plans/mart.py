"""The consumer-facing table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostersync.operators.joins import exists_flag
from rostersync.operators.rank import global_dense_rank
from rostersync.operators.staging import broadcast_if_small, materialise
from rostersync.plans.enrich import PERSON, user_groups
from rostersync.sources.schemas import ASSIGNMENT_COLUMNS, MART_COLUMNS


def group_type(
    df: DataFrame,
    lookup: DataFrame,
    trim_both: bool = False,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """``network`` if the group is one of the lookup's, else (also for NULL) ``schooling``.

    The lookup side is compared as written; ``trim_both`` drops its outer blanks first.
    """
    name = F.col("group_name")
    names = user_groups(lookup).select((F.trim(name) if trim_both else name).alias("group_name"))
    # About a hundred names, each on many rows: if they are few, no row is shuffled by them.
    names = materialise(names.where(F.col("group_name").isNotNull()).distinct(), "group-names")
    flagged = exists_flag(
        df,
        broadcast_if_small(names),
        {"looker_user_group": "group_name"},
        "__net",
        spread_by=spread_by,
    )
    return flagged.withColumn(
        "user_group_type", F.when(F.col("__net"), "network").otherwise("schooling")
    ).drop("__net")


def mart(
    reconciled: DataFrame,
    lookup: DataFrame,
    nulls: str = "first",
    trim_both: bool = False,
    rank_strategy: str = "auto",
    staged: bool = False,
) -> DataFrame:
    """Distinct rows with their group type and recency rank; 25 columns.

    A dense rank ignores duplicates, so rows are made distinct first. ``staged`` writes them down,
    so that the rank reads one column of that table and not the whole plan again.
    """
    rows = reconciled.select(*ASSIGNMENT_COLUMNS).distinct()
    if staged:
        rows = materialise(rows, "reconciled")
    ranked = global_dense_rank(rows, ["lst_updt_ts"], nulls, "rnk", rank_strategy)
    return (
        group_type(ranked, lookup, trim_both, PERSON)
        .withColumnRenamed("workday_employee_number", "dwh_workforce_id")
        .select(*MART_COLUMNS)
    )
