"""The assignment run on made inputs: against SQL, step by step, and with each option."""

import dataclasses
from collections import Counter

import duckdb
import pytest
from conftest import rows
from made_inputs import make, to_duck, to_spark
from oracle_check import compare
from pyspark.sql import functions as F

from rostersync.catalogue import oracle as O
from rostersync.catalogue.queries import _text
from rostersync.operators.checks import check_not_null, require_empty
from rostersync.operators.rank import latest_with_ties
from rostersync.operators.reconcile import reconcile
from rostersync.plans import assign, enrich
from rostersync.plans.mart import mart
from rostersync.sources.schemas import ASSIGNMENT_COLUMNS, MART_COLUMNS, PREVIOUS_COLUMNS

GIVEN = ("wf", "acct", "sch", "lk", "ovr")
CURRENT = tuple(c for c in ASSIGNMENT_COLUMNS if c != "user_group_status")


def _case(spark, seed, n=120, hot=0.0):
    made = make(seed, n, hot)
    con = duckdb.connect()
    to_duck(con, made)
    inputs, overrides = to_spark(spark, made)
    return inputs, overrides, con


@pytest.mark.parametrize("seed, hot", [(1, 0.0), (2, 0.34), (3, 0.34)])
@pytest.mark.parametrize("mode", ["pairwise", "set"])
def test_run_equals_sql(spark, seed, hot, mode):
    inputs, overrides, con = _case(spark, seed, hot=hot)
    config = assign.Config(overrides=overrides, mode=mode, hot_rows=10, salts=4)
    assert compare(_text(assign.run(inputs, config)), con, O.full_mart(mode, GIVEN)) == []


@pytest.mark.parametrize("hot", [0.0, 0.34])
def test_both_sides_equal_sql(spark, hot):
    inputs, overrides, con = _case(spark, 5, hot=hot)
    config = assign.Config(overrides=overrides, hot_rows=10, salts=4)
    old = _text(assign.previous_groups(inputs, config))
    assert compare(old, con, O.sql(O.as_text("latest_old", PREVIOUS_COLUMNS, O.TIMES), "latest_old", given=GIVEN)) == []
    new = _text(assign.current_groups(inputs, config))
    columns = (*CURRENT, "title", "department", "group_name")
    assert compare(new, con, O.sql(O.as_text("latest_new", columns, O.TIMES), "latest_new", given=GIVEN)) == []


def test_each_side_joins_the_accounts_once(spark, tmp_path, monkeypatch):
    """The join is written down and read twice; what both sides ask of the inputs is found once."""
    inputs, overrides, _ = _case(spark, 5, hot=0.34)
    inputs.accounts.write.parquet(str(tmp_path / "okta_user"))
    inputs = dataclasses.replace(inputs, accounts=spark.read.parquet(str(tmp_path / "okta_user")))
    config = assign.Config(overrides=overrides, hot_rows=10, salts=4)
    prepared = assign.prepare(inputs, config)
    alone = [rows(side(inputs, config)) for side in (assign.previous_groups, assign.current_groups)]
    monkeypatch.setattr(assign.enrich, "hot_numbers", None)
    monkeypatch.setattr(assign.enrich, "manager_directory", None)
    for side, want in zip((assign.previous_groups, assign.current_groups), alone):
        got = side(inputs, config, prepared)
        assert rows(got) == want
        read = got.inputFiles()
        assert any("/base-" in f for f in read) and not any("okta_user" in f for f in read)


@pytest.mark.parametrize(
    "options",
    [
        {"null_key": "keep_all"},
        {"previous_filter": "esd_isactive"},
        {"nulls": "last"},
        {"strip_zeros": True, "prefix_only": True, "literal_lookup": True, "trim_both": True},
        {"distinct_from": 0},
        {"rank_strategy": "range", "excluded_departments": ("Executive", "Legal")},
    ],
    ids=str,
)
def test_run_equals_its_steps(spark, options):
    """What ``run`` shares and drops early changes nothing, whatever the options."""
    options = dict(options)
    if "previous_filter" in options:
        options["previous_filter"] = (F.col("esd_isactive") == "Yes") | F.col("exitdate").isNotNull()
    inputs, overrides, _ = _case(spark, 11, n=90, hot=0.2)
    config = assign.Config(overrides=overrides, **options)
    changes = reconcile(
        assign.previous_groups(inputs, config), assign.current_groups(inputs, config).select(*CURRENT)
    )
    stepwise = mart(changes, inputs.lookup, config.nulls, config.trim_both)
    assert Counter(map(tuple, assign.run(inputs, config).collect())) == Counter(map(tuple, stepwise.collect()))


def test_order_and_partitions_do_not_matter(spark):
    inputs, overrides, _ = _case(spark, 13, n=80, hot=0.3)
    first = assign.run(inputs, assign.Config(overrides=overrides)).collect()
    mixed = type(inputs)(
        inputs.workforce.orderBy(F.desc("email_address")).repartition(9),
        inputs.accounts.repartition(5),
        inputs.schools.repartition(3),
        inputs.lookup.orderBy("network_groups").repartition(2),
    )
    again = assign.run(mixed, assign.Config(overrides=overrides.repartition(3), hot_rows=3, salts=5)).collect()
    assert Counter(map(tuple, first)) == Counter(map(tuple, again))


def test_shape_of_the_mart(spark):
    inputs, overrides, _ = _case(spark, 17, n=60)
    out = assign.run(inputs, assign.Config(overrides=overrides))
    assert tuple(out.columns) == MART_COLUMNS
    assert {r[0] for r in out.select("user_group_status").distinct().collect()} <= {"add", "remove", "Current"}
    assert {r[0] for r in out.select("user_group_type").distinct().collect()} <= {"network", "schooling"}
    require_empty(check_not_null(out, "rnk"), "rank")
    # NULL time stamps, those of leavers among them, rank first.
    assert {r[0] for r in out.where("lst_updt_ts is null").select("rnk").distinct().collect()} == {1}


def test_hot_number_on_both_sides_does_not_multiply(spark):
    """5,000 rows of one worker and 5,000 accounts of that number: 25 million pairs before ranking."""
    days = F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int"))
    null = F.lit(None)
    workforce = spark.range(5000).select(
        F.lit("E0").alias("worker_id"), F.lit("Teacher").alias("business_title"), F.lit("Legal").alias("okta_department"),
        days.alias("hire_date"), F.lit("Ann").alias("first_name"), F.lit("Lee").alias("last_name"),
        F.lit("a@example.org").alias("email_address"), F.lit("SA North").alias("company"), null.cast("string").alias("manager"),
        F.lit("Yes").alias("active"), days.alias("original_hire_date"), null.cast("date").alias("termination_date"),
        null.cast("timestamp_ntz").alias("lst_updt_ts"),
    )
    accounts = spark.range(5000).select(
        F.col("id").cast("string").alias("id"), F.lit("E0").alias("employee_number"),
        null.cast("timestamp_ntz").alias("lastupdated"), null.cast("string").alias("display_name"), F.lit("ACTIVE").alias("status"),
    )
    schools = spark.createDataFrame([("North", "HS", 22)], "esd_school_name string, school_type_abbrev string, dwh_school_year_id int")
    lookup = spark.createDataFrame([("Teacher", "leg", "Team")], "business_titles string, department_okta string, network_groups string")
    inputs = assign.Inputs(workforce, accounts, schools, lookup)
    out = assign.run(inputs, assign.Config(hot_rows=500, salts=8))
    got = {(r.looker_user_group, r.user_group_status): r["count"] for r in out.groupBy("looker_user_group", "user_group_status").count().collect()}
    # The older rules know no group here, so every account gains one and its old row stands.
    assert got == {("Team", "add"): 5000, (None, "Current"): 5000}
    assert {str(r[0]) for r in out.select("okta_hire_date").distinct().collect()} == {"2013-09-08"}


def _unthinned(inputs, config, active):
    """The rows before departments, from every pair of worker and account, as plain SQL ranks them."""
    workers = enrich.worker_rows(inputs.workforce).distinct()
    base = enrich.with_accounts(enrich.active_only(workers) if active else workers, inputs.accounts, config.strip_zeros)
    if not active:
        base = base.where(assign._previous_filter(config))
    base.createOrReplaceTempView("every_pair")
    keep = "OR okta_users_id IS NULL" if config.null_key == "keep_all" else ""
    return base.sparkSession.sql(
        f"""SELECT * EXCEPT (r) FROM (SELECT *, rank() OVER (PARTITION BY okta_users_id ORDER BY okta_hire_date DESC NULLS {config.nulls},
        date(okta_lastupdated) DESC NULLS {config.nulls}, date(esd_dateofhire) DESC NULLS {config.nulls}) r FROM every_pair) WHERE r = 1 {keep}"""
    )


FILTERS = {
    "none": None,
    "worker": lambda: (F.col("esd_isactive") == "Yes") | F.col("exitdate").isNull(),
    "account": lambda: F.coalesce(F.col("okta_status") == "ACTIVE", F.lit(True)),
    "both": lambda: (F.col("esd_isactive") == "Yes", F.col("okta_status") != "INACTIVE"),
    "mixed": lambda: (F.col("okta_hire_date") < F.col("okta_lastupdated")) | F.col("okta_users_id").isNull(),
}


@pytest.mark.parametrize(
    "kind, null_key, seed, nulls, strip_zeros",
    [(kind, key, 21, "first", False) for kind in FILTERS for key in ("rank", "keep_all")] + [("both", "keep_all", 22, "last", True)],
)
def test_latest_before_the_join_equals_latest_after_it(spark, null_key, kind, seed, nulls, strip_zeros):
    inputs, _, _ = _case(spark, seed, n=90, hot=0.3)
    chosen = FILTERS[kind]() if FILTERS[kind] else None
    config = assign.Config(previous_filter=chosen, null_key=null_key, nulls=nulls, strip_zeros=strip_zeros, hot_rows=5, salts=3)
    shared = assign._shared_latest(inputs, config)
    for flag, active in (("__previous", False), ("__current", True)):
        got = shared.where(flag).select(*[F.col("okta_department_original").alias("okta_department") if c == "okta_department" else c for c in enrich.BASE_COLUMNS]).distinct()
        want = _unthinned(inputs, config, active).select(*enrich.BASE_COLUMNS)
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect())), flag


def _hot_inputs(spark, n, ids, lost):
    """``n`` rows of one worker's number, ``ids`` accounts of that number with an id and ``lost`` without."""
    days = F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int"))
    null = F.lit(None)
    workforce = spark.range(n).select(
        F.lit("E0").alias("worker_id"), F.lit("Teacher").alias("business_title"), F.lit("Legal").alias("okta_department"),
        days.alias("hire_date"), F.lit("Ann").alias("first_name"), F.lit("Lee").alias("last_name"),
        F.lit("a@example.org").alias("email_address"), F.lit("SA North").alias("company"), null.cast("string").alias("manager"),
        F.when(F.col("id") % 2 == 0, "Yes").otherwise("No").alias("active"), days.alias("original_hire_date"),
        null.cast("date").alias("termination_date"), null.cast("timestamp_ntz").alias("lst_updt_ts"),
    )
    accounts = spark.range(ids + lost).select(
        F.when(F.col("id") < ids, F.col("id").cast("string")).alias("id"), F.lit("E0").alias("employee_number"),
        null.cast("timestamp_ntz").alias("lastupdated"), F.col("id").cast("string").alias("display_name"), F.lit("ACTIVE").alias("status"),
    )
    schools = spark.createDataFrame([("North", "HS", 22)], "esd_school_name string, school_type_abbrev string, dwh_school_year_id int")
    lookup = spark.createDataFrame([("Teacher", "leg", "Team")], "business_titles string, department_okta string, network_groups string")
    return assign.Inputs(workforce, accounts, schools, lookup)


@pytest.mark.parametrize("options", [{"null_key": "keep_all"}, {"previous_filter": True}, {"null_key": "keep_all", "previous_filter": True}], ids=str)
def test_options_make_no_pairs_of_a_number_hot_on_both_sides(spark, options):
    """4,000 rows of a number and 4,000 accounts: 16 million pairs. Two accounts without id may pair with every row."""
    options = dict(options)
    if "previous_filter" in options:
        options["previous_filter"] = (F.col("esd_isactive") == "Yes", F.col("okta_status") == "ACTIVE")
    config = assign.Config(hot_rows=400, salts=8, **options)
    lost = 2 if config.null_key == "keep_all" else 0
    inputs = _hot_inputs(spark, 4000, 4000, lost)
    workers = enrich.worker_rows(inputs.workforce)
    scopes = {"__previous": assign._of_workers(workers, inputs, config), "__current": F.col("esd_isactive") == "Yes"}
    base = assign._with_accounts(workers, inputs, config, scopes, staged=True)
    within = 2000 if config.previous_filter is not None else 4000
    best = 1 if config.previous_filter is not None else 2
    # The latest row of each scope with every account, and the other rows with those without an id.
    assert base.count() == best * (4000 + lost) + (within - best) * lost


def test_directory(spark):
    inputs, _, _ = _case(spark, 1)
    workforce = spark.createDataFrame(
        [
            ("1", "Ann", "Lee", "Legal", "Yes"),
            ("2", "ann", "LEE", "Legal", "Yes"),
            ("3", "Bob", "Ray", "Legal", "Yes"),
            ("4", "Bob", "Ray", "Finance", "Yes"),
            ("5", "Cy", "Poe", "Executive", "Yes"),
            ("6", "Di", "Fox", "Legal", "No"),
            ("7", "Ed", "Fox", "Legal", "Yes"),
            ("8", None, "Fox", "Legal", "Yes"),
            ("9", "Flo", "Fox", None, "Yes"),
        ],
        "worker_id string, first_name string, last_name string, okta_department string, active string",
    )
    accounts = spark.createDataFrame(
        [(str(i), "ACTIVE") for i in (1, 1, 2, 3, 4, 5, 6, 8, 9)] + [("7", "INACTIVE")],
        "employee_number string, status string",
    )
    assert rows(enrich.manager_directory(workforce, accounts)) == [("ann.lee", "Legal")]
    wider = enrich.manager_directory(workforce, accounts, exclude=())
    assert rows(wider) == [("ann.lee", "Legal"), ("cy.poe", "Executive")]


def test_departments_are_inherited(spark):
    workers = spark.createDataFrame(
        [(1, "Legal", "ann.lee"), (2, None, "ann.lee"), (3, None, "bob.ray"), (4, None, None)],
        "i int, okta_department string, okta_manager string",
    )
    managers = spark.createDataFrame([("ann.lee", "Finance")], "full_name string, okta_department string")
    got = enrich.inherit_department(workers, managers).select("i", "okta_department_original", "okta_department", "dept_source")
    assert sorted(map(tuple, got.collect())) == [
        (1, "Legal", "Legal", "employee"),
        (2, None, "Finance", "manager"),
        (3, None, None, None),
        (4, None, None, None),
    ]


def test_school_of_two_types_gives_two_rows(spark):
    schools = spark.createDataFrame(
        [("Foo-Bar", "ES", 22), ("Foo-Bar", "ES", 22), ("Foo-Bar", "XX", 22), ("Foo-Bar", "HS", 15)],
        "esd_school_name string, school_type_abbrev string, dwh_school_year_id int",
    )
    workers = spark.createDataFrame([("SA Foo - Bar",), ("Other",), (None,)], "company string")
    got = enrich.attach_school(workers, enrich.school_dim(schools, 22))
    assert rows(got) == [
        (None, None, None),
        ("Other", None, None),
        ("SA Foo - Bar", "ES", "Elementary School"),
        ("SA Foo - Bar", "XX", None),
    ]


def test_overrides_match_exactly_and_never_fan_out(spark):
    df = spark.createDataFrame([("a@x", "G"), ("A@x", "G"), (None, "G"), ("b@x", None)], "okta_email string, looker_user_group string")
    overrides = spark.createDataFrame([("a@x", "Two"), ("a@x", "One"), ("b@x", "Desk")], "okta_email string, override_group string")
    assert rows(enrich.apply_overrides(df, overrides)) == [(None, "G"), ("A@x", "G"), ("a@x", "One"), ("b@x", "Desk")]


def test_latest_is_picked_among_active_rows_only(spark):
    df = spark.createDataFrame([("u", 2, "No"), ("u", 1, "Yes")], "okta_users_id string, v int, esd_isactive string")
    got = latest_with_ties(enrich.active_only(df), ["okta_users_id"], [F.col("v")])
    assert rows(got) == [("u", 1, "Yes")]
