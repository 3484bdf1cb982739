"""The registered queries: name -> (Spark query, oracle SQL or None)."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostersync.catalogue import oracle as O
from rostersync.catalogue import standins as S
from rostersync.functions.text import (
    matches_part,
    name_key,
    normalise_company,
    rewrite_title,
    text_key,
)
from rostersync.operators.aggregate import count_by, single_valued
from rostersync.operators.checks import check_not_null, check_unique
from rostersync.operators.gates import Gate, gated
from rostersync.operators.joins import exists_flag, join_identity, with_active_account
from rostersync.operators.rank import global_dense_rank, latest_with_ties, rank_latest
from rostersync.operators.reconcile import diff_added, diff_removed, reconcile
from rostersync.operators.rules import Rule, classify, classify_distinct, like, unlike
from rostersync.operators.rulesets import current_rules, legacy_rules
from rostersync.operators.sets import union_all, union_distinct
from rostersync.operators.staging import materialise, staging_dir
from rostersync.plans import assign, enrich
from rostersync.plans.mart import group_type, mart
from rostersync.sources.contracts import Typed, conform
from rostersync.sources.schemas import MART_COLUMNS
from rostersync.sources.schemas import TABLES as TABLES_DECLARED
from rostersync.sources.sinks import as_table, as_view, publish, read_published
from rostersync.sources.tables import Inputs, Sources

Query = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

REGISTRY: dict[str, tuple[Query, str | None]] = {}


def register(sql: str | None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        REGISTRY[query.__name__] = (query, sql)
        return query

    return add


def _text(df: DataFrame, times: Sequence[str] = O.TIMES) -> DataFrame:
    """Dates, time stamps and identifiers as text, so that both engines print them alike."""
    return df.select(*[F.col(c).cast("string").alias(c) if c in times else F.col(c) for c in df.columns])


def _wide(relation: str, columns: Sequence[str]) -> str:
    return O.as_text(relation, tuple(columns), O.TIMES)


# --- sources, projections, filters -------------------------------------------------------------

@register(" UNION ALL ".join(f"SELECT '{t}' AS source_name, count(*) AS n_rows FROM {t}" for t in TABLES))
def scan_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [
        S.table(spark, sf_dir, t).agg(F.count("*").alias("n_rows")).select(F.lit(t).alias("source_name"), "n_rows")
        for t in TABLES
    ]
    return reduce(union_all, counts)


_PRESENT = (
    "SELECT '{0}' AS source_name, column_name, n_present FROM "
    "(UNPIVOT (SELECT count(COLUMNS(*)) AS '\\0' FROM {0}) ON COLUMNS(*) INTO NAME column_name VALUE n_present)"
)


@register(" UNION ALL ".join(_PRESENT.format(t) for t in TABLES))
def scan_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of every table read: how many of its values are present."""

    def present(name: str) -> DataFrame:
        table = S.table(spark, sf_dir, name)
        counts = table.agg(*[F.count(F.col(c)).alias(c) for c in table.columns])
        named = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_present")) for c in table.columns])
        return counts.select(F.lit(name).alias("source_name"), F.inline(named))

    return reduce(union_all, map(present, TABLES))


@register("SELECT c_custkey AS worker_id, c_name AS display_name, c_mktsegment AS department FROM customer")
def scan_rename_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Names are matched whatever their case.
    return S.table(spark, sf_dir, "customer").select(
        F.col("C_CUSTKEY").alias("worker_id"),
        F.col("c_Name").alias("display_name"),
        F.col("C_MktSegment").alias("department"),
    )


@register(
    "SELECT c.* REPLACE (lower(c_mktsegment) AS c_mktsegment), n_name, 'Current' AS user_group_status, "
    "c_acctbal > 0 AS in_credit FROM customer c JOIN nation ON c_nationkey = n_nationkey"
)
def star_plus_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, nations = S.table(spark, sf_dir, "customer").alias("c"), S.table(spark, sf_dir, "nation").alias("n")
    return (
        customers.join(nations, F.col("c.c_nationkey") == F.col("n.n_nationkey"))
        .select("c.*", "n.n_name", F.lit("Current").alias("user_group_status"))
        .withColumn("in_credit", F.col("c_acctbal") > 0)
        .withColumn("c_mktsegment", F.lower("c_mktsegment"))
    )


@register(
    O.sql(
        "SELECT CAST(worker_id AS VARCHAR) AS worker_id, business_title, okta_department FROM wf WHERE active = 'Yes' "
        "AND business_title IS NOT NULL AND okta_department IS NOT NULL AND okta_department <> 'Executive'",
        "wf",
    )
)
def filter_conjunction(spark: SparkSession, sf_dir: str) -> DataFrame:
    department = F.col("okta_department")
    return (
        S.workforce(spark, sf_dir)
        .where(
            (F.col("active") == "Yes")
            & F.col("business_title").isNotNull()
            & department.isNotNull()
            & (department != "Executive")
        )
        .select(F.col("worker_id").cast("string").alias("worker_id"), "business_title", "okta_department")
    )


@register(
    "SELECT p_partkey, p_type, p_size FROM part WHERE p_type IN ('ECONOMY', 'PROMO', 'SMALL') "
    "AND (p_size < 10 OR p_brand IN ('Brand#1', 'Brand#12'))"
)
def filter_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        S.table(spark, sf_dir, "part")
        .where(
            F.col("p_type").isin("ECONOMY", "PROMO", "SMALL")
            & ((F.col("p_size") < 10) | F.col("p_brand").isin("Brand#1", "Brand#12"))
        )
        .select("p_partkey", "p_type", "p_size")
    )


@register(
    """SELECT p_partkey, p_name ILIKE 'RED%' AS starts, p_name ILIKE '%D W%' AS holds, p_name ILIKE '%Ring' AS ends_with,
  p_name ILIKE 'blue gear' AS same, coalesce(nullif(p_name, 'cold rod') NOT ILIKE '%LARGE%', false) AS without
FROM part"""
)
def ilike_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("p_name")
    return S.table(spark, sf_dir, "part").select(
        "p_partkey",
        name.ilike("RED%").alias("starts"),
        name.ilike("%D W%").alias("holds"),
        name.ilike("%Ring").alias("ends_with"),
        name.ilike("blue gear").alias("same"),
        F.coalesce(~F.nullif(name, F.lit("cold rod")).ilike("%LARGE%"), F.lit(False)).alias("without"),
    )


@register(
    O.sql(
        """SELECT email_address, network_groups,
  CASE WHEN okta_department ILIKE '%' || department_okta || '%' THEN 'yes'
    WHEN NOT okta_department ILIKE '%' || department_okta || '%' THEN 'no' ELSE 'unknown' END AS by_pattern,
  CASE WHEN contains(lower(okta_department), lower(department_okta)) THEN 'yes'
    WHEN NOT contains(lower(okta_department), lower(department_okta)) THEN 'no' ELSE 'unknown' END AS by_text
FROM wf JOIN lk ON business_title = business_titles""",
        "wf",
        "lk",
    )
)
def ilike_dynamic_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = S.workforce(spark, sf_dir).join(
        S.lookup(spark, sf_dir), F.col("business_title") == F.col("business_titles")
    )

    def answer(literal: bool):
        hit = matches_part(F.col("okta_department"), F.col("department_okta"), literal)
        return F.when(hit, "yes").when(~hit, "no").otherwise("unknown")

    return pairs.select(
        "email_address", "network_groups", answer(False).alias("by_pattern"), answer(True).alias("by_text")
    )


@register(
    O.sql(
        """SELECT email_address, replace(business_title, ', ', '--') AS okta_title, lower(manager) AS okta_manager,
  replace(replace(company, 'SA ', ''), ' - ', '-') AS school, lower(first_name) || '.' || lower(last_name) AS full_name,
  trim('  ' || business_title || ' ') AS trimmed, replace(replace(business_title, 'SA ', ''), ' - ', '-') AS every_token
FROM (SELECT * REPLACE (business_title || ' SA SA x' AS business_title) FROM wf)""",
        "wf",
    )
)
def text_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.workforce(spark, sf_dir).withColumn(
        "business_title", F.concat("business_title", F.lit(" SA SA x"))
    )
    title = F.col("business_title")
    return rows.select(
        "email_address",
        rewrite_title(title).alias("okta_title"),
        F.lower("manager").alias("okta_manager"),
        normalise_company(F.col("company")).alias("school"),
        name_key(F.col("first_name"), F.col("last_name")).alias("full_name"),
        F.trim(F.concat(F.lit("  "), title, F.lit(" "))).alias("trimmed"),
        normalise_company(title).alias("every_token"),
    )


@register(
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS key_text, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day,
  coalesce(nullif(o_orderpriority, '5-LOW'), o_orderstatus) AS mark FROM orders"""
)
def cast_and_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text_key(F.col("o_custkey")).alias("key_text"),
        F.col("o_orderdate").cast("date").cast("string").alias("order_day"),
        F.coalesce(F.nullif("o_orderpriority", F.lit("5-LOW")), "o_orderstatus").alias("mark"),
    )


_PART_RULES = (
    Rule("red ring", (like("p_name", "red%"), like("p_name", "%RING"))),
    Rule("red", (like("p_name", "RED%"),)),
    Rule("not hot or large", (unlike("p_name", "%hot%", "%large%"), like("p_type", "%o%", "%s%"))),
)


@register(
    """SELECT p_partkey, CASE WHEN lower(p_name) = 'red ring' THEN 'red ring' WHEN starts_with(p_name, 'red') THEN 'red'
  WHEN NOT regexp_matches(p_name, 'hot|large') AND regexp_matches(p_type, '[oOsS]') THEN 'not hot or large' END AS grp FROM part"""
)
def case_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(S.table(spark, sf_dir, "part"), _PART_RULES, name="grp").select("p_partkey", "grp")


# --- joins and aggregates ----------------------------------------------------------------------

@register(
    O.sql(
        "SELECT email_address, id, display_name, status FROM wf LEFT JOIN acct ON CAST(worker_id AS VARCHAR) = employee_number",
        "wf",
        "acct",
    )
)
def join_identity_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = join_identity(S.workforce(spark, sf_dir), S.accounts(spark, sf_dir))
    return joined.select("email_address", "id", "display_name", "status")


@register(
    O.sql(
        "SELECT DISTINCT email_address FROM wf LEFT JOIN acct ON CAST(worker_id AS VARCHAR) = employee_number "
        "WHERE status = 'ACTIVE' AND active = 'Yes'",
        "wf",
        "acct",
    )
)
def join_identity_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    workers = S.workforce(spark, sf_dir).where(F.col("active") == "Yes")
    return with_active_account(workers, S.accounts(spark, sf_dir)).select("email_address")


@register(
    "SELECT o_custkey, count(*) AS n FROM (SELECT DISTINCT o_custkey, o_orderpriority, o_orderstatus FROM orders) GROUP BY 1 HAVING count(*) > 5"
)
def distinct_count_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = S.table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus").distinct()
    return count_by(pairs, "o_custkey").where(F.col("n") > 5)


@register("SELECT o_custkey, max(o_orderpriority) AS o_orderpriority FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) = 1")
def single_valued_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single_valued(S.table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority")


@register(O.sql("SELECT * FROM directory", "directory"))
def single_valued_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.manager_directory(S.workforce(spark, sf_dir), S.accounts(spark, sf_dir))


@register(O.sql(_wide("base_old", enrich.BASE_COLUMNS), "base_old"))
def worker_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(enrich.worker_base(S.workforce(spark, sf_dir), S.accounts(spark, sf_dir), rewrite_title=True))


def _inherited(spark: SparkSession, sf_dir: str, rewrite: bool) -> DataFrame:
    workforce, accounts = S.workforce(spark, sf_dir), S.accounts(spark, sf_dir)
    return enrich.inherit_department(
        enrich.worker_base(workforce, accounts, rewrite_title=rewrite),
        enrich.manager_directory(workforce, accounts),
    )


def _placed(spark: SparkSession, sf_dir: str, rewrite: bool, year: int) -> DataFrame:
    return enrich.attach_school(
        _inherited(spark, sf_dir, rewrite), enrich.school_dim(S.schools(spark, sf_dir), year)
    )


_DEPARTMENT = (
    "okta_email", "okta_users_id", "okta_title", "okta_manager", "okta_department_original", "okta_department", "dept_source",
)


@register(O.sql(_wide("inherited_new", _DEPARTMENT), "inherited_new"))
def inherit_department(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(_inherited(spark, sf_dir, False).select(*_DEPARTMENT))


@register(O.sql("SELECT 15 AS year_id, * FROM dim15 UNION ALL SELECT 22, * FROM dim22", "dim15", "dim22"))
def school_dim_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    schools = S.schools(spark, sf_dir)
    return union_all(
        *[enrich.school_dim(schools, year).select(F.lit(year).alias("year_id"), "*") for year in (15, 22)]
    )


_PLACE = ("okta_email", "okta_users_id", "company", "school_type_abbrev", "school_model")


@register(O.sql(_wide("placed_old", _PLACE), "placed_old"))
def attach_school(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _placed(spark, sf_dir, True, 22).select(*_PLACE)


@register(O.sql("SELECT okta_email, okta_users_id, okta_title, okta_department, title, department, group_name FROM found_new", "found_new"))
def lookup_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = enrich.user_groups(S.lookup(spark, sf_dir))
    return enrich.lookup_group(_placed(spark, sf_dir, False, 15), groups).select(
        "okta_email", "okta_users_id", "okta_title", "okta_department", "title", "department", "group_name"
    )


_GROUPED = ("okta_email", "okta_users_id", "okta_title", "okta_department", "school_model", "looker_user_group")


@register(O.sql(_wide("grouped_old", _GROUPED), "grouped_old"))
def classify_legacy_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_placed(spark, sf_dir, True, 22), legacy_rules()).select(*_GROUPED)


def _grouped_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = enrich.lookup_group(
        _placed(spark, sf_dir, False, 15), enrich.user_groups(S.lookup(spark, sf_dir))
    )
    return classify(found, current_rules(), default="group_name")


@register(O.sql(_wide("grouped_new", (*_GROUPED, "group_name")), "grouped_new"))
def classify_current_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grouped_now(spark, sf_dir).select(*_GROUPED, "group_name")


@register(O.sql(_wide("grouped_old", _GROUPED), "grouped_old"))
def classify_distinct_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older rules, once for each distinct tuple of what they read."""
    return classify_distinct(_placed(spark, sf_dir, True, 22), legacy_rules()).select(*_GROUPED)


@register(O.sql(_wide("grouped_new", (*_GROUPED, "group_name")), "grouped_new"))
def classify_distinct_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup's patterns once for each title and department, then the current rules once for each tuple."""
    placed = materialise(_placed(spark, sf_dir, False, 15), "placed")
    found = enrich.lookup_group(placed, enrich.user_groups(S.lookup(spark, sf_dir)), distinct=True)
    return classify_distinct(found, current_rules(), default="group_name").select(*_GROUPED, "group_name")


@register(O.sql(_wide("overridden_new", _GROUPED), "overridden_new"))
def override_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.apply_overrides(_grouped_now(spark, sf_dir), S.overrides(spark, sf_dir)).select(*_GROUPED)


# --- ranks -------------------------------------------------------------------------------------

_RANKED = ("okta_email", "okta_users_id", "okta_hire_date", "okta_lastupdated", "esd_dateofhire")


@register(
    O.sql(_wide(f"({O._latest('(SELECT * FROM base_new WHERE esd_isactive = ' + chr(39) + 'Yes' + chr(39) + ')')})", _RANKED), "base_new")
)
def active_then_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = enrich.worker_base(S.workforce(spark, sf_dir), S.accounts(spark, sf_dir))
    latest = latest_with_ties(enrich.active_only(base), ["okta_users_id"], enrich.latest_order())
    return _text(latest.select(*_RANKED))


@register(
    "SELECT o_custkey, o_orderkey, CAST(o_orderdate AS VARCHAR) AS o_orderdate FROM orders "
    "QUALIFY dense_rank() OVER (PARTITION BY o_custkey ORDER BY date_trunc('year', o_orderdate) DESC, o_orderpriority DESC) = 1"
)
def latest_with_ties_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = S.table(spark, sf_dir, "orders")
    order = [F.date_trunc("year", F.col("o_orderdate")), F.col("o_orderpriority")]
    return _text(latest_with_ties(orders, ["o_custkey"], order), ["o_orderdate"]).select(
        "o_custkey", "o_orderkey", "o_orderdate"
    )


@register(O.sql(_wide(f"({O._latest('base_old')})", _RANKED), "base_old"))
def latest_with_ties_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = enrich.worker_base(S.workforce(spark, sf_dir), S.accounts(spark, sf_dir), rewrite_title=True)
    return _text(latest_with_ties(base, ["okta_users_id"], enrich.latest_order()).select(*_RANKED))


@register(
    O.sql(
        _wide(f"({O._latest('(SELECT * FROM base_old WHERE okta_users_id IS NOT NULL)')} UNION ALL SELECT * FROM base_old WHERE okta_users_id IS NULL)", _RANKED),
        "base_old",
    )
)
def latest_with_ties_keep_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = enrich.worker_base(S.workforce(spark, sf_dir), S.accounts(spark, sf_dir), rewrite_title=True)
    latest = latest_with_ties(base, ["okta_users_id"], enrich.latest_order(), null_key="keep_all")
    return _text(latest.select(*_RANKED))


@register(
    "SELECT o_orderkey, CAST(dense_rank() OVER (PARTITION BY nullif(o_custkey % 50, 0) ORDER BY nullif(o_orderpriority, '5-LOW') DESC NULLS LAST, "
    "CAST(o_orderdate AS DATE) DESC) AS BIGINT) AS rnk FROM orders"
)
def rank_latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = S.table(spark, sf_dir, "orders").withColumn("grp", F.nullif(F.col("o_custkey") % 50, F.lit(0)))
    order = [F.nullif("o_orderpriority", F.lit("5-LOW")), F.col("o_orderdate").cast("date")]
    return rank_latest(orders, ["grp"], order, nulls="last", strategy="range").select("o_orderkey", "rnk")


_EVENT_RANK = (
    "SELECT event_id, CAST(dense_rank() OVER (ORDER BY CASE WHEN event_id % 97 <> 0 THEN {ts} END DESC NULLS {nulls}) AS BIGINT) AS rnk FROM events"
)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 97 != 0, F.col("ts")).alias("ts")
    )


@register(_EVENT_RANK.format(ts="ts", nulls="FIRST"))
def global_dense_rank_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return global_dense_rank(_events(spark, sf_dir), ["ts"]).select("event_id", "rnk")


@register(_EVENT_RANK.format(ts="date_trunc('hour', ts)", nulls="LAST"))
def global_dense_rank_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = _events(spark, sf_dir).withColumn("ts", F.date_trunc("hour", F.col("ts")))
    return global_dense_rank(hours, ["ts"], nulls="last", strategy="distinct").select("event_id", "rnk")


@register(_EVENT_RANK.format(ts="ts", nulls="FIRST"))
def global_dense_rank_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return global_dense_rank(_events(spark, sf_dir), ["ts"], strategy="range").select("event_id", "rnk")


# --- differences and the mart ------------------------------------------------------------------

_SNAP = (
    "workday_employee_number", "okta_users_id", "looker_user_group", "lst_updt_ts", "okta_hire_date", "user_group_status",
)
_SNAP_SQL = ", ".join(c for c in _SNAP if c != "user_group_status")


@register(O.sql(_wide(f"({O._added('snap_new', 'snap_old', _SNAP_SQL)})", _SNAP), "snap_new", "snap_old"))
def diff_added_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    previous, current = S.snapshots(spark, sf_dir)
    return _text(diff_added(current, previous).select(*_SNAP))


@register(O.sql(_wide(f"({O._removed('snap_old', 'snap_new', _SNAP_SQL)})", _SNAP), "snap_new", "snap_old"))
def diff_removed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    previous, current = S.snapshots(spark, sf_dir)
    return _text(diff_removed(previous, current).select(*_SNAP))


_TRIMMED = "SELECT * REPLACE (trim(looker_user_group) AS looker_user_group) FROM ({})"
_SNAP_PAIRS = f"{O._added('snap_new', 'snap_old', _SNAP_SQL)} UNION {O._removed('snap_old', 'snap_new', _SNAP_SQL)}"


@register(O.sql(_wide(f"({_TRIMMED.format(_SNAP_PAIRS)})", _SNAP), "snap_new", "snap_old"))
def reconcile_pairwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(reconcile(*S.snapshots(spark, sf_dir)).select(*_SNAP))


@register(
    O.sql(_wide(f"({_TRIMMED.format(O._set_diff('snap_new', 'snap_old', _SNAP_SQL))})", _SNAP), "snap_new", "snap_old")
)
def reconcile_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(reconcile(*S.snapshots(spark, sf_dir), mode="set").select(*_SNAP))


_LATEST_SNAP = "(SELECT * FROM {} QUALIFY dense_rank() OVER (PARTITION BY workday_employee_number ORDER BY okta_hire_date DESC NULLS FIRST) = 1)"
_LATEST_PAIRS = (
    f"{O._added(_LATEST_SNAP.format('snap_new'), _LATEST_SNAP.format('snap_old'), _SNAP_SQL)} UNION "
    f"{O._removed(_LATEST_SNAP.format('snap_old'), _LATEST_SNAP.format('snap_new'), _SNAP_SQL)}"
)


@register(O.sql(f"SELECT user_group_status, count(*) AS n FROM ({_LATEST_PAIRS}) GROUP BY 1", "snap_new", "snap_old"))
def snapshot_change_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = [
        latest_with_ties(side, ["workday_employee_number"], [F.col("okta_hire_date")])
        for side in S.snapshots(spark, sf_dir)
    ]
    return count_by(reconcile(*latest), "user_group_status")


_KEYS_SQL = "SELECT c_custkey AS id FROM customer {} SELECT s_suppkey AS id FROM supplier"


@register(
    _KEYS_SQL.format("UNION ALL") + " UNION ALL SELECT CAST(NULL AS BIGINT) AS id FROM nation"
)
def union_all_with_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = S.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    suppliers = S.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    missing = S.table(spark, sf_dir, "nation").select(F.lit(None).cast("bigint").alias("id"))
    return reduce(union_all, (customers, suppliers, missing))


@register(_KEYS_SQL.format("UNION"))
def union_distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = S.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    suppliers = S.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    return union_distinct(customers, suppliers)


@register("SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT') AS urgent FROM customer")
def exists_flag_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = S.table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    customers = S.table(spark, sf_dir, "customer").select("c_custkey")
    return exists_flag(customers, urgent, {"c_custkey": "o_custkey"}, "urgent")


@register(
    O.sql(
        "SELECT okta_email, okta_users_id, looker_user_group, CASE WHEN EXISTS (SELECT 1 FROM lk WHERE network_groups = looker_user_group) "
        "THEN 'network' ELSE 'schooling' END AS user_group_type "
        "FROM (SELECT * REPLACE (trim(looker_user_group) AS looker_user_group) FROM grouped_new)",
        "grouped_new",
        "lk",
    )
)
def group_type_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _grouped_now(spark, sf_dir).withColumn("looker_user_group", F.trim("looker_user_group"))
    return group_type(rows, S.lookup(spark, sf_dir)).select(
        "okta_email", "okta_users_id", "looker_user_group", "user_group_type"
    )


def _config(spark: SparkSession, sf_dir: str, **more: object) -> assign.Config:
    return assign.Config(overrides=S.overrides(spark, sf_dir), **more)


@register(O.sql(_wide("latest_old", assign.PREVIOUS_COLUMNS), "latest_old"))
def previous_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(assign.previous_groups(S.inputs(spark, sf_dir)))


_CURRENT = tuple(c for c in assign.ASSIGNMENT_COLUMNS if c != "user_group_status")


@register(O.sql(_wide("latest_new", (*_CURRENT, "title", "department", "group_name")), "latest_new"))
def current_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(assign.current_groups(S.inputs(spark, sf_dir), _config(spark, sf_dir)))


@register(O.sql(_wide(f"({O.KEEP_ALL_OLD})", assign.PREVIOUS_COLUMNS), "grouped_old"))
def previous_groups_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest before the join, with a filter on either side and every row without an account kept."""
    active = (F.col("esd_isactive") == "Yes") | F.col("okta_hire_date").isNull()
    standing = F.coalesce("okta_status", F.lit("ACTIVE")) == "ACTIVE"
    config = assign.Config(null_key="keep_all", previous_filter=(active, standing))
    return _text(assign.previous_groups(S.inputs(spark, sf_dir), config))


@register(O.full_mart())
def mart_of_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each step on its own: both assignments stored, then ``reconcile`` and ``mart``."""
    inputs, config = S.inputs(spark, sf_dir), _config(spark, sf_dir)
    prepared = assign.prepare(inputs, config)
    previous = materialise(assign.previous_groups(inputs, config, prepared), "previous")
    current = materialise(assign.current_groups(inputs, config, prepared).select(*_CURRENT), "current")
    changes = reconcile(previous, current, staged=True)
    return _text(mart(changes, inputs.lookup, staged=True))


def _stored_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """The stand-ins written as tables and loaded by name, as a user's own inputs are."""
    root = f"{staging_dir(spark)}/{spark.sparkContext.applicationId}/inputs-{uuid.uuid4().hex}"
    made = S.inputs(spark, sf_dir)
    for name, df in (
        ("dim_workforce", made.workforce),
        ("okta_user", made.accounts),
        ("dim_school", made.schools),
        ("looker_user_group", made.lookup),
    ):
        as_table(df, path=f"{root}/{name}.parquet")
    return Inputs.from_sources(Sources(spark, root))


@register(O.full_mart())
def assignment_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through ``run``, which shares what both sides have in common, from stored inputs."""
    return _text(assign.run(_stored_inputs(spark, sf_dir), _config(spark, sf_dir)))


@register(O.full_mart("set"))
def assignment_run_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(assign.run(_stored_inputs(spark, sf_dir), _config(spark, sf_dir, mode="set")))


@register(O.full_mart())
def assignment_run_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run under its gates, published twice; what is current is read back."""
    target = f"{staging_dir(spark)}/{spark.sparkContext.applicationId}/published-{uuid.uuid4().hex}"
    inputs = _stored_inputs(spark, sf_dir)
    publish(inputs.schools, target)
    assign.run_and_publish(inputs, target, _config(spark, sf_dir))
    return _text(read_published(spark, target))


# --- typed loading -----------------------------------------------------------------------------

def _typed_workforce(spark: SparkSession, sf_dir: str) -> Typed:
    return conform(S.workforce_as_text(spark, sf_dir), TABLES_DECLARED["dim_workforce"], "dim_workforce", "set_aside")


@register(O.sql(O.TYPED_WORKFORCE, "wf"))
def typed_workforce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workers exported as text, in their declared types; rows with a value that has none are set aside."""
    days = ("hire_date", "original_hire_date", "termination_date", "lst_updt_ts")
    return _typed_workforce(spark, sf_dir).rows.select("worker_id", "email_address", *[F.col(c).cast("string").alias(c) for c in days])


@register(O.sql(O.REJECTED_WORKFORCE, "wf"))
def rejected_workforce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values for which they were set aside."""
    rejected = _typed_workforce(spark, sf_dir).rejected
    email = F.get_json_object("row", "$.email_address").alias("email_address")
    return rejected.select(email, F.inline("problems")).select("email_address", "column", "declared", "value")


# --- checks and sinks --------------------------------------------------------------------------

@register("SELECT o_custkey, count(*) AS n_records FROM orders GROUP BY 1 HAVING count(*) > 1")
def check_unique_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_unique(S.table(spark, sf_dir, "orders"), "o_custkey")


@register("SELECT event_id FROM events WHERE event_id % 97 = 0")
def check_not_null_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_not_null(_events(spark, sf_dir), "ts").select("event_id")


_GATES = {
    "not_null": (Gate("orders", "not_null", ("o_custkey", "o_orderdate")), "count(*) FILTER (o_custkey IS NULL OR o_orderdate IS NULL)"),
    "unique": (Gate("orders", "unique", ("o_custkey", "o_orderdate")), "max((SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1 AND o_custkey IS NOT NULL AND o_orderdate IS NOT NULL)))"),
    "accepted": (Gate("orders", "accepted", ("o_orderstatus",), ("F", "O")), "count(*) FILTER (o_orderstatus NOT IN ('F', 'O'))"),
    "holds": (Gate("orders", "holds", test="o_totalprice > 50000"), "count(*) FILTER (NOT o_totalprice > 50000)"),
    "rows": (Gate("orders", "rows", least=10**7), "greatest(0, 10000000 - count(*))"),
}


@register(" UNION ALL ".join(f"SELECT '{kind}' AS gate, CAST({sql} AS BIGINT) AS violations FROM orders" for kind, (_, sql) in _GATES.items()))
def gates_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each gate counts while the orders are written."""
    with gated([gate for gate, _ in _GATES.values()], stop=False) as watch:
        materialise(S.table(spark, sf_dir, "orders"), "orders")
    return spark.createDataFrame([(o.gate.kind, o.violations) for o in watch.outcomes], "gate string, violations long")


@register("SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def view_and_table_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through a named view, then a stored table, then an aggregate of what was read back."""
    name = f"segments_{uuid.uuid4().hex}"
    seen = as_view(S.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), name)
    stored = as_table(seen, path=f"{staging_dir(spark)}/{spark.sparkContext.applicationId}/{name}")
    return count_by(stored, "c_mktsegment")
