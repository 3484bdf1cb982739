"""Workers with their accounts, departments, schools and lookup groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostersync.functions.text import name_key, normalise_company, rewrite_title, text_key
from rostersync.operators.aggregate import single_valued
from rostersync.operators.hot import HotKeys, hot_keys
from rostersync.operators.joins import (
    HOT_ROWS,
    SALTS,
    attach,
    exists_flag,
    join_identity,
    join_lookup,
    join_lookup_distinct,
    with_active_account,
)
from rostersync.operators.rulesets import SCHOOL_MODELS
from rostersync.operators.staging import broadcast_if_small, materialise

# Columns of an assignment row that tell rows apart and that every step reads anyway; the last two also
# tell apart rows with neither number nor account.
PERSON = ("workday_employee_number", "okta_users_id", "okta_email", "lst_updt_ts")

# Worker columns, as input name -> output name.
_WORKER_NAMES = {
    "worker_id": "workday_employee_number",
    "okta_department": "okta_department",
    "hire_date": "okta_hire_date",
    "company": "company",
    "first_name": "first_name",
    "last_name": "last_name",
    "active": "esd_isactive",
    "original_hire_date": "esd_dateofhire",
    "termination_date": "exitdate",
    "lst_updt_ts": "lst_updt_ts",
    "email_address": "okta_email",
}
_ACCOUNT_NAMES = {
    "id": "okta_users_id",
    "lastupdated": "okta_lastupdated",
    "display_name": "display_name",
    "status": "okta_status",
}

BASE_COLUMNS = ("okta_title", "okta_manager", *_WORKER_NAMES.values(), *_ACCOUNT_NAMES.values())


def worker_rows(workforce: DataFrame, rewrite: bool = False) -> DataFrame:
    """Workers with a title, renamed; manager names in lower case, titles optionally rewritten."""
    title = F.col("business_title")
    return workforce.where(title.isNotNull()).select(
        (rewrite_title(title) if rewrite else title).alias("okta_title"),
        F.lower("manager").alias("okta_manager"),
        *[F.col(old).alias(new) for old, new in _WORKER_NAMES.items()],
    )


def account_rows(accounts: DataFrame) -> DataFrame:
    """The account columns in use, each distinct row once."""
    return accounts.select(
        "employee_number", *[F.col(old).alias(new) for old, new in _ACCOUNT_NAMES.items()]
    ).distinct()


def with_accounts(
    workers: DataFrame,
    accounts: DataFrame,
    strip_zeros: bool = False,
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
    staged: bool = False,
    hot_list: HotKeys | None = None,
) -> DataFrame:
    """Renamed workers LEFT JOIN the distinct accounts."""
    return join_identity(
        workers,
        account_rows(accounts),
        "workday_employee_number",
        "employee_number",
        strip_zeros,
        hot_rows,
        salts,
        staged,
        spread_by=["okta_hire_date", "esd_dateofhire", "lst_updt_ts"],
        bucket_by=["okta_users_id", "okta_lastupdated"],
        count_from=accounts,
        hot_list=hot_list,
    ).select(*BASE_COLUMNS)


def hot_numbers(accounts: DataFrame, strip_zeros: bool = False, hot_rows: int = HOT_ROWS) -> HotKeys:
    """Employee numbers with more than ``hot_rows`` accounts, for all joins on them."""
    return hot_keys(accounts, text_key(F.col("employee_number"), strip_zeros), hot_rows)


def with_accounts_of_the_lost(
    workers: DataFrame,
    accounts: DataFrame,
    strip_zeros: bool = False,
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
    staged: bool = False,
    hot_list: HotKeys | None = None,
) -> DataFrame:
    """Of renamed workers LEFT JOIN the distinct accounts, the rows without an account id.

    Those are the workers whose number no account has, and the pairs with an account that has no id.
    Accounts with an id only say whether they have the number, so they make no pair.
    """
    rows = account_rows(accounts)
    numbers = accounts.select(text_key(F.col("employee_number"), strip_zeros).alias("__held_number"))
    marked = exists_flag(
        workers.withColumn("__number", text_key(F.col("workday_employee_number"), strip_zeros)),
        numbers.where(F.col("__held_number").isNotNull()),
        {"__number": "__held_number"},
        "__held",
        spread_by=["okta_hire_date", "esd_dateofhire", "lst_updt_ts"],
    ).drop("__number")
    joined = join_identity(
        marked,
        rows.where(F.col("okta_users_id").isNull()).withColumn("__paired", F.lit(True)),
        "workday_employee_number",
        "employee_number",
        strip_zeros,
        hot_rows,
        salts,
        staged,
        spread_by=["okta_hire_date", "esd_dateofhire", "lst_updt_ts"],
        bucket_by=["okta_lastupdated", "display_name"],
        hot_list=hot_list,
    )
    return joined.where(F.col("__paired") | ~F.col("__held")).select(*BASE_COLUMNS)


def worker_base(
    workforce: DataFrame,
    accounts: DataFrame,
    rewrite_title: bool = False,
    strip_zeros: bool = False,
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Distinct workers with a title and their accounts, one row per account.

    Both inputs are made distinct before the join: copies collapse map-side and do not multiply,
    and the join of two distinct relations on the whole account row is distinct again.
    """
    workers = worker_rows(workforce, rewrite_title).distinct()
    return with_accounts(workers, accounts, strip_zeros, hot_rows, salts)


def manager_directory(
    workforce: DataFrame,
    accounts: DataFrame,
    exclude: Sequence[str] = ("Executive",),
    strip_zeros: bool = False,
) -> DataFrame:
    """``full_name`` -> ``okta_department`` of active workers with an active account.

    Only names that stand for exactly one department; NULL and excluded departments do not count.
    """
    department = F.col("okta_department")
    allowed = department.isNotNull()
    for name in exclude:
        allowed = allowed & (department != name)
    managers = workforce.where((F.col("active") == "Yes") & allowed).select(
        "worker_id", name_key(F.col("first_name"), F.col("last_name")).alias("full_name"), "okta_department"
    )
    held = with_active_account(managers.where(F.col("full_name").isNotNull()), accounts, strip_zeros=strip_zeros)
    return single_valued(held, "full_name", "okta_department")


def inherit_department(
    workers: DataFrame, managers: DataFrame, spread_by: Sequence[str] | None = None
) -> DataFrame:
    """Own department, else the manager's, with ``dept_source`` telling which.

    The own department stays as ``okta_department_original``. ``spread_by``, here and below: the
    columns that spread rows whose key is NULL.
    """
    side = managers.select("full_name", F.col("okta_department").alias("__inherited"))
    own = F.col("okta_department_original")
    return (
        attach(
            workers.withColumnRenamed("okta_department", "okta_department_original"),
            side,
            {"okta_manager": "full_name"},
            spread_by=spread_by,
        )
        .withColumn("okta_department", F.coalesce(own, F.col("__inherited")))
        .withColumn(
            "dept_source",
            F.when(own.isNotNull(), "employee").when(F.col("__inherited").isNotNull(), "manager"),
        )
        .drop("__inherited")
    )


def school_dim(schools: DataFrame, year_id: int) -> DataFrame:
    """Distinct (name, type code, long type name) of one school year; other codes have no long name."""
    code = F.col("school_type_abbrev")
    model = None
    for abbreviation, name in SCHOOL_MODELS.items():
        test = code == abbreviation
        model = F.when(test, name) if model is None else model.when(test, name)
    return (
        schools.where(F.col("dwh_school_year_id") == year_id)
        .select("esd_school_name", "school_type_abbrev", model.alias("school_model"))
        .distinct()
    )


def attach_school(
    workers: DataFrame,
    schools: DataFrame,
    prefix_only: bool = False,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Type of the school named by the worker's company; a school of two types gives two rows.

    Distinct workers stay distinct, so no further pass over the wide rows is needed.
    """
    key = normalise_company(F.col("company"), prefix_only)
    return attach(
        workers.withColumn("__school", key),
        broadcast_if_small(schools),
        {"__school": "esd_school_name"},
        spread_by=spread_by,
    ).drop("__school")


def user_groups(lookup: DataFrame) -> DataFrame:
    """The lookup sheet as (title, department, group_name)."""
    return lookup.select(
        F.col("business_titles").alias("title"),
        F.col("department_okta").alias("department"),
        F.col("network_groups").alias("group_name"),
    )


def lookup_group(workers: DataFrame, groups: DataFrame, literal: bool = False, distinct: bool = False) -> DataFrame:
    """Group by exact title and department pattern; every match gives a row.

    ``distinct`` tests each pair of title and department once.
    """
    groups = broadcast_if_small(materialise(groups, "lookup"))
    if distinct:
        return join_lookup_distinct(workers, groups, literal=literal, spread_by=PERSON)
    return join_lookup(workers, groups, literal=literal)


def apply_overrides(
    df: DataFrame,
    overrides: DataFrame,
    key: str = "okta_email",
    value: str = "looker_user_group",
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Replace the group of the people listed in ``overrides`` (``key``, ``override_group``).

    Addresses compare exactly. Of an address listed twice the row with the smallest ``priority`` counts
    (its place in the list; NULL last), the smallest group among equals or where there is no such column.
    """
    place = [F.col("priority").isNull(), F.col("priority")] if "priority" in overrides.columns else []
    first = F.min_by("override_group", F.struct(*place, F.col("override_group")))
    side = overrides.groupBy(F.col(key).alias("__who")).agg(first.alias("__override"))
    # Staged first: asking for the size of a derived relation would compute it twice.
    side = materialise(side, "overrides")
    return (
        attach(df, broadcast_if_small(side), {key: "__who"}, spread_by=spread_by)
        .withColumn(value, F.coalesce("__override", F.col(value)))
        .drop("__override")
    )


def active_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("esd_isactive") == "Yes")


def latest_order() -> list[Column]:
    """What makes an account's record the latest: hire, last update, first hire; dates only."""
    return [
        F.col("okta_hire_date"),
        F.col("okta_lastupdated").cast("date"),
        F.col("esd_dateofhire").cast("date"),
    ]
