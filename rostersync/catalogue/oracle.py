"""The same answers in plain SQL, written apart from the Spark code.

Stand-ins are named relations; ``sql(final, *names)`` puts those a query needs, and what they need,
in front of it. Rules are checked in another form than the CASE chain: as a table of tests joined to
the facts, keeping rules all of whose tests hold and taking the first.
"""

from __future__ import annotations

from rostersync.catalogue.standins import (
    CURRENT_SINCE,
    DEPARTMENTS,
    PREVIOUS_UNTIL,
    SNAPSHOT_RULES,
    TITLES,
)
from rostersync.operators.rules import Rule
from rostersync.operators.rulesets import SCHOOL_MODELS, current_rules, legacy_rules
from rostersync.plans.enrich import BASE_COLUMNS
from rostersync.sources.schemas import ASSIGNMENT_COLUMNS, MART_COLUMNS


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(_quote(v) for v in values) + "]"


WORKFORCE = f"""
SELECT CASE WHEN c_custkey % 89 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN c_custkey - 1 ELSE c_custkey END AS worker_id,
  CASE WHEN p_size <> 13 THEN list_extract({_list(TITLES)}, (c_custkey * 7 + p_size) % {len(TITLES)} + 1) END AS business_title,
  CASE WHEN c_mktsegment <> 'FURNITURE' THEN list_extract({_list(DEPARTMENTS)}, (c_custkey + p_size * 5) % {len(DEPARTMENTS)} + 1) END AS okta_department,
  CASE WHEN c_custkey % 53 <> 0 THEN CAST(DATE '2015-01-01' + c_nationkey * 30 AS DATE) END AS hire_date,
  CASE WHEN c_custkey % 41 <> 0 THEN 'Customer' END AS first_name,
  CAST(c_custkey // 2 AS VARCHAR) AS last_name,
  lower(c_name) || '@example.org' AS email_address,
  'SA ' || replace(p_brand, '#', ' - ') AS company,
  CASE WHEN c_custkey % 37 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN 'Erin.Example'
    WHEN c_custkey % 23 = 0 THEN 'Finn.Example' WHEN c_custkey % 29 = 0 THEN 'Dan.Example'
    ELSE 'Customer.' || CAST(c_custkey // 3 AS VARCHAR) END AS manager,
  CASE WHEN c_acctbal > 1000 THEN 'Yes' ELSE 'No' END AS active,
  CASE WHEN c_custkey % 47 <> 0 THEN CAST(CAST(DATE '2010-01-01' + CAST(c_custkey % 50 AS INTEGER) AS DATE) AS VARCHAR) END AS original_hire_date,
  CASE WHEN NOT c_acctbal > 1000 THEN CAST(DATE '2023-01-01' + p_size AS DATE) END AS termination_date,
  CASE WHEN c_custkey % 97 <> 0 THEN TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(c_custkey % 500 AS INTEGER)) END AS lst_updt_ts
FROM customer LEFT JOIN part ON c_custkey = p_partkey"""

ACCOUNTS = """
SELECT CAST(CASE WHEN o_orderkey % 4 = 1 THEN o_orderkey - 1 ELSE o_orderkey END AS VARCHAR) AS id,
  CASE WHEN o_custkey % 3 <> 0 AND o_orderpriority <> '2-HIGH' THEN '' ELSE 'N' END || CAST(o_custkey AS VARCHAR) AS employee_number,
  o_orderdate AS lastupdated,
  CASE WHEN o_orderkey % 50 = 0 THEN 'Ada Example' ELSE nullif(o_orderpriority, '5-LOW') END AS display_name,
  CASE o_orderstatus WHEN 'F' THEN 'INACTIVE' ELSE 'ACTIVE' END AS status
FROM orders"""

SCHOOLS = """
SELECT 'Brand-' || CAST(n_nationkey AS VARCHAR) AS esd_school_name,
  CASE WHEN y = 15 AND n_nationkey % 4 = 0 THEN 'OT' WHEN r_name = 'ASIA' THEN 'ES'
    WHEN r_name = 'EUROPE' THEN 'MS' WHEN r_name = 'AFRICA' THEN 'HS' ELSE 'OT' END AS school_type_abbrev,
  y AS dwh_school_year_id
FROM nation JOIN region ON n_regionkey = r_regionkey, (VALUES (15), (22)) AS years(y)
UNION ALL SELECT 'Brand-7', 'HS', 22 FROM nation WHERE n_nationkey = 7"""

LOOKUP = """
SELECT t AS business_titles,
  CASE length(t) % 5 WHEN 0 THEN 'Support' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN 'e_' ELSE 'fin' END AS department_okta,
  'Network ' || t || CASE WHEN length(t) % 3 = 0 THEN ' ' ELSE '' END AS network_groups
FROM (SELECT DISTINCT business_title AS t FROM wf WHERE business_title IS NOT NULL)
UNION ALL
SELECT t, 'school', CASE WHEN length(t) % 2 = 0 THEN 'Regional Operations Manager ' ELSE 'School Team ' END || t
FROM (SELECT DISTINCT business_title AS t FROM wf WHERE business_title IS NOT NULL)"""

OVERRIDES = """
SELECT lower(c_name) || '@example.org' AS okta_email, arg_min(g, p) AS override_group
FROM customer JOIN (VALUES (7, 2, 'Archive'), (7, 1, 'Help Desk'), (8, 1, 'Schooling Application')) AS listed(r, p, g)
  ON c_custkey % 250 = r
GROUP BY 1"""

DIRECTORY = """
SELECT n AS full_name, any_value(d) AS okta_department FROM (
  SELECT DISTINCT lower(first_name) || '.' || lower(last_name) AS n, okta_department AS d FROM wf
  WHERE active = 'Yes' AND okta_department <> 'Executive' AND EXISTS (
    SELECT 1 FROM acct WHERE status = 'ACTIVE' AND employee_number = CAST(worker_id AS VARCHAR)))
WHERE n IS NOT NULL GROUP BY n HAVING count(*) = 1"""


def _base(title: str, where: str = "") -> str:
    return f"""
SELECT DISTINCT {title} AS okta_title, lower(manager) AS okta_manager, worker_id AS workday_employee_number,
  okta_department, hire_date AS okta_hire_date, company, first_name, last_name, active AS esd_isactive,
  original_hire_date AS esd_dateofhire, termination_date AS exitdate, lst_updt_ts, email_address AS okta_email,
  id AS okta_users_id, lastupdated AS okta_lastupdated, display_name, status AS okta_status
FROM wf LEFT JOIN acct ON CAST(worker_id AS VARCHAR) = employee_number
WHERE business_title IS NOT NULL{where}"""


def _inherited(base: str) -> str:
    return f"""
SELECT b.* EXCLUDE (okta_department), b.okta_department AS okta_department_original,
  coalesce(b.okta_department, d.okta_department) AS okta_department,
  CASE WHEN b.okta_department IS NOT NULL THEN 'employee' WHEN d.okta_department IS NOT NULL THEN 'manager' END AS dept_source
FROM {base} b LEFT JOIN directory d ON b.okta_manager = d.full_name"""


_MODELS = " ".join(f"WHEN {_quote(a)} THEN {_quote(n)}" for a, n in SCHOOL_MODELS.items())


def _school_dim(year: int) -> str:
    return f"""
SELECT DISTINCT esd_school_name, school_type_abbrev,
  CASE school_type_abbrev {_MODELS} END AS school_model
FROM sch WHERE dwh_school_year_id = {year}"""


def _placed(workers: str, dim: str) -> str:
    return f"""
SELECT DISTINCT w.*, s.school_type_abbrev, s.school_model FROM {workers} w
LEFT JOIN {dim} s ON s.esd_school_name = replace(replace(w.company, 'SA ', ''), ' - ', '-')"""


def _with_lookup(workers: str) -> str:
    return f"""
SELECT w.*, business_titles AS title, department_okta AS department, network_groups AS group_name
FROM {workers} w LEFT JOIN lk ON w.okta_title = business_titles
  AND w.okta_department ILIKE '%' || department_okta || '%'"""


def _grouped(rows: str, rules: tuple[Rule, ...], default: str = "NULL") -> str:
    """Rows with ``looker_user_group``, by relational division over a table of tests."""
    columns = sorted({t.column for r in rules for t in r.tests})
    suffixes = sorted({r.suffix for r in rules if r.suffix})
    facts = ", ".join(dict.fromkeys([*columns, *suffixes]))
    tests = ",\n".join(
        f"({i}, {j}, {_quote(t.column)}, {_quote(t.op)}, {_quote(v)})"
        for i, r in enumerate(rules)
        for j, t in enumerate(r.tests)
        for v in t.values
    )
    names = ", ".join(
        f"({i}, {_quote(r.label)}, {len(r.tests)}, {'true' if r.suffix else 'false'})" for i, r in enumerate(rules)
    )
    value = "CASE col " + " ".join(f"WHEN {_quote(c)} THEN f.{c}" for c in columns) + " END"
    label = "label"
    if suffixes:
        label = f"CASE WHEN suffixed THEN label || ' (' || {suffixes[0]} || ')' ELSE label END"
    same = " AND ".join(f"x.{c} IS NOT DISTINCT FROM w.{c}" for c in dict.fromkeys([*columns, *suffixes]))
    return f"""
SELECT w.*, CASE WHEN x.rule IS NOT NULL THEN x.chosen ELSE {default} END AS looker_user_group
FROM {rows} w LEFT JOIN (
  SELECT {facts}, rule, {label} AS chosen
  FROM (
    SELECT {facts}, min(rule) AS rule FROM (
      SELECT {facts}, t.rule, count(DISTINCT test) AS passed
      FROM (SELECT DISTINCT {facts} FROM {rows}) f
      JOIN (VALUES {tests}) AS t(rule, test, col, op, val)
        ON CASE op WHEN 'is' THEN {value} = val WHEN 'like' THEN {value} ILIKE val ELSE {value} NOT ILIKE val END
      GROUP BY {facts}, t.rule) p
    JOIN (VALUES {names}) AS r(rule_id, label, n_tests, suffixed) ON rule = rule_id AND passed = n_tests
    GROUP BY {facts}) q
  JOIN (VALUES {names}) AS r(rule_id, label, n_tests, suffixed) ON rule = rule_id
) x ON {same}"""


def _latest(rows: str) -> str:
    return f"""
SELECT * FROM {rows} QUALIFY dense_rank() OVER (PARTITION BY okta_users_id
  ORDER BY okta_hire_date DESC NULLS FIRST, CAST(okta_lastupdated AS DATE) DESC NULLS FIRST,
    CAST(esd_dateofhire AS DATE) DESC NULLS FIRST) = 1"""


def _period(period: str) -> str:
    rows = f"(SELECT * FROM orders WHERE {period})"
    return f"""
SELECT CASE WHEN o_custkey % 101 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS workday_employee_number,
  CAST(o_orderkey AS VARCHAR) AS okta_users_id, looker_user_group,
  CAST(date_trunc('year', o_orderdate) AS TIMESTAMP) AS lst_updt_ts, o_orderdate AS okta_hire_date, 'Current' AS user_group_status
FROM ({_grouped(rows, SNAPSHOT_RULES)}) g"""


def _added(new: str, old: str, columns: str) -> str:
    """All pairs of a key, then those that differ or have no partner."""
    return f"""
SELECT DISTINCT {columns}, 'add' AS user_group_status
FROM {new} a LEFT JOIN (SELECT workday_employee_number AS k, looker_user_group AS g FROM {old}) b
  ON a.workday_employee_number = k
WHERE k IS NULL OR g IS NULL OR looker_user_group <> g"""


def _removed(old: str, new: str, columns: str) -> str:
    return f"""
SELECT DISTINCT {columns}, status AS user_group_status FROM (
  SELECT a.* EXCLUDE (workday_employee_number, lst_updt_ts), k AS workday_employee_number, ts AS lst_updt_ts,
    CASE WHEN k IS NULL OR g IS NULL OR looker_user_group <> g THEN 'remove' ELSE user_group_status END AS status
  FROM {old} a LEFT JOIN (
    SELECT workday_employee_number AS k, looker_user_group AS g, lst_updt_ts AS ts FROM {new}) b
  ON a.workday_employee_number = k)"""


def _set_diff(new: str, old: str, columns: str) -> str:
    pair = "(x.workday_employee_number = a.workday_employee_number AND x.looker_user_group = a.looker_user_group)"
    return f"""
SELECT DISTINCT {columns}, 'add' AS user_group_status FROM {new} a
WHERE looker_user_group IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {old} x WHERE {pair})
UNION
SELECT DISTINCT {columns}, CASE WHEN EXISTS (SELECT 1 FROM {new} x WHERE {pair}) THEN user_group_status ELSE 'remove' END
FROM {old} a WHERE looker_user_group IS NOT NULL"""


def _mart(rows: str) -> str:
    """Of trimmed rows."""
    plain = ", ".join(c for c in ASSIGNMENT_COLUMNS if c != "workday_employee_number")
    return f"""
SELECT DISTINCT workday_employee_number AS dwh_workforce_id, {plain},
  CASE WHEN looker_user_group IN (SELECT network_groups FROM lk WHERE network_groups IS NOT NULL)
    THEN 'network' ELSE 'schooling' END AS user_group_type,
  CAST(dense_rank() OVER (ORDER BY lst_updt_ts DESC NULLS FIRST) AS BIGINT) AS rnk
FROM (SELECT * REPLACE (trim(looker_user_group) AS looker_user_group) FROM ({rows}))"""


_PLAIN = ", ".join(c for c in ASSIGNMENT_COLUMNS if c != "user_group_status")
_ORDER_PLAIN = "workday_employee_number, okta_users_id, looker_user_group, lst_updt_ts, okta_hire_date"

# Name -> (what it reads, its SQL).
RELATIONS: dict[str, tuple[tuple[str, ...], str]] = {
    "wf": ((), WORKFORCE),
    "acct": ((), ACCOUNTS),
    "sch": ((), SCHOOLS),
    "lk": (("wf",), LOOKUP),
    "ovr": ((), OVERRIDES),
    "directory": (("wf", "acct"), DIRECTORY),
    "dim15": (("sch",), _school_dim(15)),
    "dim22": (("sch",), _school_dim(22)),
    "base_old": (("wf", "acct"), _base("replace(business_title, ', ', '--')")),
    "base_new": (("wf", "acct"), _base("business_title")),
    "inherited_old": (("base_old", "directory"), _inherited("base_old")),
    "inherited_new": (("base_new", "directory"), _inherited("base_new")),
    "placed_old": (("inherited_old", "dim22"), _placed("inherited_old", "dim22")),
    "placed_new": (("inherited_new", "dim15"), _placed("inherited_new", "dim15")),
    "found_new": (("placed_new", "lk"), _with_lookup("placed_new")),
    "grouped_old": (("placed_old",), _grouped("placed_old", legacy_rules())),
    "grouped_new": (("found_new",), _grouped("found_new", current_rules(), "w.group_name")),
    "latest_old": (("grouped_old",), _latest("(SELECT *, 'Current' AS user_group_status FROM grouped_old)")),
    "overridden_new": (
        ("grouped_new", "ovr"),
        "SELECT g.* REPLACE (coalesce(override_group, looker_user_group) AS looker_user_group) "
        "FROM grouped_new g LEFT JOIN ovr USING (okta_email)",
    ),
    "latest_new": (
        ("overridden_new",),
        _latest("(SELECT * FROM overridden_new WHERE esd_isactive = 'Yes')"),
    ),
    "snap_old": ((), _period(f"o_orderdate < TIMESTAMP '{PREVIOUS_UNTIL}'")),
    "snap_new": ((), _period(f"o_orderdate >= TIMESTAMP '{CURRENT_SINCE}' OR o_orderdate IS NULL")),
    "added": (("latest_new", "latest_old"), _added("latest_new", "latest_old", _PLAIN)),
    "removed": (("latest_new", "latest_old"), _removed("latest_old", "latest_new", _PLAIN)),
}


def sql(final: str, *needs: str, given: tuple[str, ...] = ()) -> str:
    """``final`` with the relations it needs, except ``given`` ones, in front of it."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in given:
            return
        for other in RELATIONS[name][0]:
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    if not ordered:
        return final
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({RELATIONS[n][1]})" for n in ordered) + "\n" + final


def as_text(relation: str, columns: tuple[str, ...], times: tuple[str, ...]) -> str:
    """SELECT with dates and time stamps as text."""
    picked = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" if c in times else c for c in columns)
    return f"SELECT {picked} FROM {relation}"


TIMES = ("okta_hire_date", "esd_dateofhire", "exitdate", "lst_updt_ts", "okta_lastupdated", "workday_employee_number", "dwh_workforce_id")


def full_mart(mode: str = "pairwise", given: tuple[str, ...] = ()) -> str:
    if mode == "set":
        rows, needs = _set_diff("latest_new", "latest_old", _PLAIN), ("latest_new", "latest_old")
    else:
        rows, needs = "SELECT * FROM added UNION SELECT * FROM removed", ("added", "removed")
    return sql(as_text(f"({_mart(rows)})", MART_COLUMNS, TIMES), *needs, "lk", given=given)


# The workers as text, and what the declared types make of them.
TEXT_WORKFORCE = """
SELECT worker_id, email_address, CASE WHEN worker_id % 59 = 0 THEN 'n/a' WHEN worker_id % 61 = 0 THEN '2021-02-30' WHEN worker_id % 67 = 0 THEN ''
    ELSE CAST(hire_date AS VARCHAR) END AS hire_date,
  original_hire_date, termination_date + to_hours(CASE WHEN worker_id % 71 = 0 THEN 9 ELSE 0 END) AS termination_date,
  CASE WHEN worker_id % 73 = 0 THEN '2024-01-01 25:00:00' ELSE strftime(lst_updt_ts, '%Y-%m-%d %H:%M:%S') END AS lst_updt_ts
FROM wf"""
TYPED_WORKFORCE = f"""
SELECT CAST(worker_id AS VARCHAR) AS worker_id, email_address, CAST(TRY_CAST(hire_date AS DATE) AS VARCHAR) AS hire_date,
  CAST(TRY_CAST(original_hire_date AS DATE) AS VARCHAR) AS original_hire_date,
  CAST(CAST(termination_date AS DATE) AS VARCHAR) AS termination_date, CAST(TRY_CAST(lst_updt_ts AS TIMESTAMP) AS VARCHAR) AS lst_updt_ts
FROM ({TEXT_WORKFORCE})
WHERE (hire_date IS NULL OR TRY_CAST(hire_date AS DATE) IS NOT NULL) AND (lst_updt_ts IS NULL OR TRY_CAST(lst_updt_ts AS TIMESTAMP) IS NOT NULL)
  AND (termination_date IS NULL OR CAST(CAST(termination_date AS DATE) AS TIMESTAMP) = termination_date)"""
REJECTED_WORKFORCE = f"""
SELECT email_address, 'hire_date' AS "column", 'date' AS declared, hire_date AS "value" FROM ({TEXT_WORKFORCE}) AS t WHERE hire_date IS NOT NULL AND TRY_CAST(hire_date AS DATE) IS NULL
UNION ALL SELECT email_address, 'lst_updt_ts', 'timestamp_ntz', lst_updt_ts FROM ({TEXT_WORKFORCE}) AS t WHERE lst_updt_ts IS NOT NULL AND TRY_CAST(lst_updt_ts AS TIMESTAMP) IS NULL
UNION ALL SELECT email_address, 'termination_date', 'date', strftime(termination_date, '%Y-%m-%d %H:%M:%S') FROM ({TEXT_WORKFORCE}) AS t
  WHERE CAST(CAST(termination_date AS DATE) AS TIMESTAMP) <> termination_date"""

# The older side with a filter, rows without an account id each kept.
FILTERED_OLD = "SELECT *, 'Current' AS user_group_status FROM grouped_old WHERE (esd_isactive = 'Yes' OR okta_hire_date IS NULL) AND coalesce(okta_status, 'ACTIVE') = 'ACTIVE'"
KEEP_ALL_OLD = f"SELECT * FROM ({_latest(f'({FILTERED_OLD} AND okta_users_id IS NOT NULL)')}) UNION ALL BY NAME SELECT * FROM ({FILTERED_OLD}) WHERE okta_users_id IS NULL"

BASE_TEXT = as_text("base_new", BASE_COLUMNS, TIMES)
