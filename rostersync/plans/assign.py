"""The two assignment relations and the whole run."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostersync.operators.gates import Gate, gated
from rostersync.operators.hot import HotKeys
from rostersync.operators.joins import HOT_ROWS, SALTS
from rostersync.operators.rank import flag_latest, latest_with_ties
from rostersync.operators.reconcile import reconcile_rows, trim_value
from rostersync.operators.rules import classify, classify_distinct
from rostersync.operators.rulesets import People, current_rules, legacy_rules
from rostersync.operators.staging import materialise, run_folder
from rostersync.functions.text import rewrite_title
from rostersync.plans import enrich
from rostersync.plans.mart import mart
from rostersync.sources.schemas import ASSIGNMENT_COLUMNS, PREVIOUS_COLUMNS
from rostersync.sources.sinks import publish
from rostersync.sources.tables import Inputs


@dataclass(frozen=True)
class Config:
    """Parameters of a run. The two school years."""

    previous_year: int = 22
    current_year: int = 15
    people: People = field(default_factory=People)
    # Rows (okta_email, override_group); None for no overrides.
    overrides: DataFrame | None = None
    excluded_departments: tuple[str, ...] = ("Executive",)
    nulls: str = "first"
    null_key: str = "rank"
    # A condition on worker_base columns (other than the title) that previous rows must meet before
    # they are ranked; several that must all hold, each on columns of workers or of accounts alone, let
    # the run drop workers before they meet their accounts.
    previous_filter: Column | tuple[Column, ...] | None = None
    mode: str = "pairwise"
    literal_lookup: bool = False
    strip_zeros: bool = False
    prefix_only: bool = False
    trim_both: bool = False
    rank_strategy: str = "auto"
    hot_rows: int = HOT_ROWS
    salts: int = SALTS
    # From so many latest records on, a run classifies distinct inputs and joins the answers back.
    distinct_from: int = 5_000_000
    # Checks on the staged relations (by their labels) that stop the run.
    gates: tuple[Gate, ...] = (
        Gate("directory", "not_null", ("full_name", "okta_department")),
        Gate("directory", "unique", ("full_name",)),
        Gate("reconciled", "not_null", ("user_group_status",)),
        Gate("reconciled", "accepted", ("user_group_status",), ("add", "remove", "Current")),
    )


def _directory(inputs: Inputs, config: Config) -> DataFrame:
    return enrich.manager_directory(
        inputs.workforce, inputs.accounts, config.excluded_departments, config.strip_zeros
    )


@dataclass(frozen=True)
class Prepared:
    """What either assignment asks of the inputs: the managers' departments, written down, and the hot numbers."""

    directory: DataFrame
    hot_list: HotKeys


def prepare(inputs: Inputs, config: Config = Config()) -> Prepared:
    """One pass each, for callers that make both assignments."""
    hot_list = enrich.hot_numbers(inputs.accounts, config.strip_zeros, config.hot_rows)
    return Prepared(materialise(_directory(inputs, config), "directory"), hot_list)


def _as_previous(rows: DataFrame, inputs: Inputs, config: Config, distinct: bool = False) -> DataFrame:
    """Latest rows with departments -> school, older rules, constant status."""
    placed = enrich.attach_school(
        rows,
        enrich.school_dim(inputs.schools, config.previous_year),
        config.prefix_only,
        spread_by=enrich.PERSON,
    )
    return (
        (classify_distinct if distinct else classify)(placed, legacy_rules(config.people))
        .withColumn("user_group_status", F.lit("Current"))
        .select(*PREVIOUS_COLUMNS)
    )


def _as_current(rows: DataFrame, inputs: Inputs, config: Config, distinct: bool = False) -> DataFrame:
    """Latest active rows with departments -> school, lookup, current rules, overrides."""
    placed = enrich.attach_school(
        rows,
        enrich.school_dim(inputs.schools, config.current_year),
        config.prefix_only,
        spread_by=enrich.PERSON,
    )
    found = enrich.lookup_group(placed, enrich.user_groups(inputs.lookup), config.literal_lookup, distinct)
    grouped = (classify_distinct if distinct else classify)(found, current_rules(), default="group_name")
    if config.overrides is not None:
        grouped = enrich.apply_overrides(grouped, config.overrides, spread_by=enrich.PERSON)
    return grouped


def _conditions(config: Config) -> tuple[Column, ...]:
    given = config.previous_filter
    return () if given is None else given if isinstance(given, tuple) else (given,)


def _previous_filter(config: Config) -> Column:
    return reduce(Column.__and__, _conditions(config), F.lit(True))


def _reads_only(df: DataFrame, condition: Column) -> bool:
    try:
        df.select(condition)
    except AnalysisException:
        return False
    return True


def _of_workers(workers: DataFrame, inputs: Inputs, config: Config) -> Column | None:
    """What the filter of the previous side asks of the worker alone; None where a condition mixes both sides.

    A condition on the account alone has one answer for all workers of an account, so it takes no part in
    choosing among them.
    """
    accounts = enrich.account_rows(inputs.accounts)
    asked = F.lit(True)
    for condition in _conditions(config):
        if _reads_only(workers, condition):
            asked = asked & condition
        elif not _reads_only(accounts, condition):
            return None
    return asked


def _with_accounts(
    workers: DataFrame,
    inputs: Inputs,
    config: Config,
    scopes: Mapping[str, Column],
    staged: bool = False,
    hot_list: HotKeys | None = None,
) -> DataFrame:
    """Workers and their accounts, without the rows that can be no account's latest within any scope.

    An account's order is the hire date, the account's own last update, the first hire date: among the
    workers of a number the best tuple of their two dates decides, whatever the account. So the best
    workers per number and scope are picked by an aggregation first, and a number that is hot on both sides
    never makes its pairs. Rows without an account id have no such rank where each of them is kept
    (``null_key="keep_all"``); they are joined apart, without the accounts that have an id.
    """
    dates = [F.col("okta_hire_date"), F.col("esd_dateofhire").cast("date")]
    flagged = flag_latest(workers, ["workday_employee_number"], dates, scopes, config.nulls, staged)
    if config.null_key == "keep_all" and staged:
        flagged = materialise(flagged, "best-workers")
    best = reduce(Column.__or__, [F.col(name) for name in scopes])
    if staged and hot_list is None:
        hot_list = enrich.hot_numbers(inputs.accounts, config.strip_zeros, config.hot_rows)
    options = (inputs.accounts, config.strip_zeros, config.hot_rows, config.salts, staged, hot_list)
    base = enrich.with_accounts(flagged.where(best).drop(*scopes), *options)
    if config.null_key == "keep_all":
        within = reduce(Column.__or__, [F.coalesce(c, F.lit(False)) for c in scopes.values()])
        others = flagged.where(~best & within).drop(*scopes)
        base = base.unionByName(enrich.with_accounts_of_the_lost(others, *options))
    return base


def _all_pairs(
    workers: DataFrame, inputs: Inputs, config: Config, staged: bool = False, hot_list: HotKeys | None = None
) -> DataFrame:
    """Workers and their accounts, every pair: for a filter that compares the two."""
    options = (inputs.accounts, config.strip_zeros, config.hot_rows, config.salts, staged, hot_list)
    return enrich.with_accounts(workers, *options)


def _latest_with_department(base: DataFrame, directory: DataFrame, config: Config) -> DataFrame:
    """Ranking needs only dates of worker and account, and the joins after it drop no row, so the
    latest records are picked before departments, schools and rules are looked up. It reads the account
    join twice (best dates per account, then the rows), so that is written down."""
    latest = latest_with_ties(
        materialise(base, "base"), ["okta_users_id"], enrich.latest_order(), config.nulls, config.null_key, staged=True
    )
    return enrich.inherit_department(latest, directory, spread_by=enrich.PERSON)


def previous_groups(
    inputs: Inputs, config: Config = Config(), prepared: Prepared | None = None
) -> DataFrame:
    """The older assignment: one group per latest account record, inactive people included."""
    prepared = prepared or prepare(inputs, config)
    workers = enrich.worker_rows(inputs.workforce, rewrite=True).distinct()
    asked = _of_workers(workers, inputs, config)
    if asked is None:
        base = _all_pairs(workers, inputs, config, True, prepared.hot_list)
    else:
        base = _with_accounts(workers, inputs, config, {"__previous": asked}, True, prepared.hot_list)
    base = base.where(_previous_filter(config))
    return _as_previous(_latest_with_department(base, prepared.directory, config), inputs, config)


def current_groups(
    inputs: Inputs, config: Config = Config(), prepared: Prepared | None = None
) -> DataFrame:
    """The current assignment: active people only, filtered before ranking.

    Keeps the lookup's ``title``, ``department`` and ``group_name`` beside the assignment columns.
    """
    prepared = prepared or prepare(inputs, config)
    workers = enrich.active_only(enrich.worker_rows(inputs.workforce)).distinct()
    base = _with_accounts(workers, inputs, config, {"__current": F.lit(True)}, True, prepared.hot_list)
    return _as_current(_latest_with_department(base, prepared.directory, config), inputs, config).select(
        *[c for c in ASSIGNMENT_COLUMNS if c != "user_group_status"], "title", "department", "group_name"
    )


def _shared_latest(inputs: Inputs, config: Config) -> DataFrame:
    """Records that are latest for either side, with departments and one flag per side.

    Both sides read the same people. The account join is written down, because the ranking reads it
    twice (best dates per account, then the rows); ranking and department join run once.
    """
    workers = enrich.worker_rows(inputs.workforce)
    active = F.col("esd_isactive") == "Yes"
    asked = _of_workers(workers, inputs, config)
    if asked is None:
        base = _all_pairs(workers, inputs, config, staged=True)
    else:
        base = _with_accounts(workers, inputs, config, {"__previous": asked, "__current": active}, staged=True)
    base = materialise(base, "base")
    flagged = flag_latest(
        base,
        ["okta_users_id"],
        enrich.latest_order(),
        {"__previous": _previous_filter(config), "__current": active},
        config.nulls,
        staged=True,
    )
    if config.null_key == "keep_all":
        lost = F.col("okta_users_id").isNull()
        kept = _previous_filter(config)
        flagged = flagged.withColumns(
            {
                "__previous": F.col("__previous") | (lost & F.coalesce(kept, F.lit(False))),
                "__current": F.col("__current") | (lost & F.coalesce(active, F.lit(False))),
            }
        )
    latest = flagged.where(F.col("__previous") | F.col("__current"))
    directory = materialise(_directory(inputs, config), "directory")
    return materialise(
        enrich.inherit_department(latest, directory, spread_by=enrich.PERSON), "latest"
    )


def run(inputs: Inputs, config: Config = Config()) -> DataFrame:
    """The whole chain: both assignments, their reconciliation and the mart.

    Written to the shared folder and read back: workers with accounts, the directory, the latest
    records, both sides after their rules, the reconciled rows, besides narrow lists (contested keys,
    lookups, distinct time stamps). The comparison reads each side twice, so that its joins and rules
    run once. Duplicates are removed once, at the end, because no join before it multiplies them.
    """
    with gated(config.gates):
        return _run(inputs, config)


def _run(inputs: Inputs, config: Config) -> DataFrame:
    latest = _shared_latest(inputs, config)
    flags = ("__previous", "__current")
    # The count is read off the stored files.
    distinct = latest.count() >= config.distinct_from
    previous = _as_previous(
        latest.where("__previous").drop(*flags).withColumn("okta_title", rewrite_title(F.col("okta_title"))),
        inputs,
        config,
        distinct,
    )
    current = _as_current(latest.where("__current").drop(*flags), inputs, config, distinct)
    current = current.select(*[c for c in ASSIGNMENT_COLUMNS if c != "user_group_status"])
    changes = reconcile_rows(
        materialise(previous.select(*ASSIGNMENT_COLUMNS), "previous"),
        materialise(current, "current"),
        mode=config.mode,
        staged=True,
        hot_rows=config.hot_rows,
        salts=config.salts,
    )
    return mart(
        trim_value(changes),
        inputs.lookup,
        config.nulls,
        config.trim_both,
        config.rank_strategy,
        staged=True,
    )


def run_and_publish(inputs: Inputs, target: str, config: Config = Config()) -> DataFrame:
    """The run as a whole: its result becomes the current version at ``target``, all it staged goes.

    A run that fails, by a gate or otherwise, leaves the version published before, and nothing else. The
    manifest notes how many rows broke which gate.
    """
    spark = inputs.workforce.sparkSession
    with run_folder(spark, "assignment") as folder:
        result = run(inputs, config)
        passed = {name: n for relation in folder.written for name, n in relation["gates"].items()}
        return publish(result, target, {"gates": passed})
