"""Stand-ins for the four inputs, derived from the test tables by Spark.

They grow with the tables. NULLs, repeated numbers, shared accounts and schools of two types are
built in, because the test tables have none of them. ``oracle.py`` says the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostersync.operators.rules import Rule, classify, is_, like
from rostersync.sources.tables import Inputs, check_columns

# Titles and departments the two rule sets tell apart, with some no rule knows.
TITLES = (
    "Assessment Coordinator",
    "Assistant Principal",
    "Senior Leader, Campus",
    "Principal",
    "Associate Dean",
    "Dean of Students",
    "Sprint Coach",
    "School Psychologist",
    "Social Emotional Specialist",
    "Business Operations Manager",
    "College Counselor",
    "Robertson Leadership Fellow",
    "Registrar",
    "Office Assistant",
    "Data Scientist",
    "ED&A Analyst",
    "Enterprise Data & Analytics",
    "Family Care Associate",
    "Family Experience Partner",
    "Family Engagement Partner",
    "Marketing Manager",
    "Operations Management Partner",
    "Regional Operations Manager",
    "Content Design Partner",
    "Learning Quality Lead",
    "Learning Quality Associate",
    "Head, School Management",
    "Knowledge Partner",
    "EI Data Analyst",
    "Chief of Staff",
    "Team Lead",
    "Program Manager",
    "Executive Director",
    "Director",
    "Lead, Mathematics",
    "Leader, Humanities",
    "Technology Lead",
    "Technology Manager",
    "Technology Partner",
    "Teacher",
    "Counsel",
)
DEPARTMENTS = (
    "Support",
    "School Leadership",
    "Support",
    "School Operations",
    "School Leadership",
    "Scholar Talent (Family Group)",
    "Enterprise Services",
    "Finance",
    "Public Affairs",
    "Education Institute",
    "Schooling",
    "Advancement",
    "Advisory",
    "Human Capital",
    "Executive",
    "Network School Operations",
    "Legal",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def _unless(test: Column, value: Column) -> Column:
    return F.when(~test, value)


def _plus_days(day: str, days: Column) -> Column:
    return F.date_add(F.lit(day).cast("date"), days.cast("int"))


def workforce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as workers. Two neighbours share a name, and some share a number."""
    n, size = F.col("c_custkey"), F.col("p_size")
    rows = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "part"), F.col("c_custkey") == F.col("p_partkey"), "left"
    )
    working = F.col("c_acctbal") > 1000
    return rows.select(
        F.when(n % 89 == 0, None).when(n % 10 == 1, n - 1).otherwise(n).alias("worker_id"),
        _unless(size == 13, _pick(TITLES, n * 7 + size)).alias("business_title"),
        _unless(F.col("c_mktsegment") == "FURNITURE", _pick(DEPARTMENTS, n + size * 5)).alias("okta_department"),
        _unless(n % 53 == 0, _plus_days("2015-01-01", F.col("c_nationkey") * 30)).alias("hire_date"),
        _unless(n % 41 == 0, F.lit("Customer")).alias("first_name"),
        F.floor(n / 2).cast("string").alias("last_name"),
        F.concat(F.lower("c_name"), F.lit("@example.org")).alias("email_address"),
        F.concat(F.lit("SA "), F.replace(F.col("p_brand"), F.lit("#"), F.lit(" - "))).alias("company"),
        F.when(n % 37 == 0, None)
        .when(n % 19 == 0, "Erin.Example")
        .when(n % 23 == 0, "Finn.Example")
        .when(n % 29 == 0, "Dan.Example")
        .otherwise(F.concat(F.lit("Customer."), F.floor(n / 3).cast("string")))
        .alias("manager"),
        F.when(working, "Yes").otherwise("No").alias("active"),
        _unless(n % 47 == 0, _plus_days("2010-01-01", n % 50).cast("string")).alias("original_hire_date"),
        _unless(working, _plus_days("2023-01-01", size)).alias("termination_date"),
        _unless(
            n % 97 == 0,
            F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(hours=(n % 500).cast("int")),
        ).alias("lst_updt_ts"),
    )


def workforce_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The workers as an export of text: some days are none, some are blank, one hour does not exist."""
    rows = workforce(spark, sf_dir)
    n, day, stamp = F.col("worker_id"), F.col("hire_date").cast("string"), F.col("lst_updt_ts").cast("string")
    return rows.withColumns(
        {
            "hire_date": F.when(n % 59 == 0, "n/a").when(n % 61 == 0, "2021-02-30").when(n % 67 == 0, "").otherwise(day),
            "termination_date": F.col("termination_date").cast("timestamp_ntz") + F.make_dt_interval(hours=F.when(n % 71 == 0, 9).otherwise(0)),
            "lst_updt_ts": F.when(n % 73 == 0, "2024-01-01 25:00:00").otherwise(stamp),
        }
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as accounts. Two neighbours in four share an account id; some have a number no worker has."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    known = (customer % 3 != 0) & (F.col("o_orderpriority") != "2-HIGH")
    return table(spark, sf_dir, "orders").select(
        F.when(key % 4 == 1, key - 1).otherwise(key).cast("string").alias("id"),
        F.when(known, customer.cast("string"))
        .otherwise(F.concat(F.lit("N"), customer.cast("string")))
        .alias("employee_number"),
        F.col("o_orderdate").alias("lastupdated"),
        F.when(key % 50 == 0, "Ada Example")
        .otherwise(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))
        .alias("display_name"),
        F.when(F.col("o_orderstatus") == "F", "INACTIVE").otherwise("ACTIVE").alias("status"),
    )


def schools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as schools in two years; one school has two types in one of them."""
    key, region = F.col("n_nationkey"), F.col("r_name")
    code = F.when(region == "ASIA", "ES").when(region == "EUROPE", "MS").when(region == "AFRICA", "HS").otherwise("OT")
    years = F.explode(F.array(F.lit(15), F.lit(22))).alias("dwh_school_year_id")
    rows = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(key, code.alias("code"), years)
    )
    codes = F.when((key == 7) & (F.col("dwh_school_year_id") == 22), F.array("code", F.lit("HS"))).otherwise(
        F.array(
            F.when((key % 4 == 0) & (F.col("dwh_school_year_id") == 15), "OT").otherwise(F.col("code"))
        )
    )
    return rows.select(
        F.concat(F.lit("Brand-"), key.cast("string")).alias("esd_school_name"),
        F.explode(codes).alias("school_type_abbrev"),
        "dwh_school_year_id",
    )


def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rows per title in use: patterns with a wildcard, empty and NULL; some groups end in a blank."""
    title = F.col("business_title")
    size = F.length(title)
    titles = workforce(spark, sf_dir).where(title.isNotNull()).select(title).distinct()
    part = (
        F.when(size % 5 == 0, "Support").when(size % 5 == 1, "").when(size % 5 == 2, None)
        .when(size % 5 == 3, "e_").otherwise("fin")
    )
    blank = F.when(size % 3 == 0, " ").otherwise("")
    other = F.when(size % 2 == 0, "Regional Operations Manager ").otherwise("School Team ")
    pairs = F.array(
        F.struct(part.alias("department_okta"), F.concat(F.lit("Network "), title, blank).alias("network_groups")),
        F.struct(F.lit("school").alias("department_okta"), F.concat(other, title).alias("network_groups")),
    )
    return titles.select(title.alias("business_titles"), F.inline(pairs))


def overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few people with a group of their own; half of them are listed twice, the first row counts."""
    n = F.col("c_custkey")
    once = F.array(F.struct(F.lit(1).alias("priority"), F.lit("Schooling Application").alias("override_group")))
    twice = F.array(
        F.struct(F.lit(2).alias("priority"), F.lit("Archive").alias("override_group")),
        F.struct(F.lit(1).alias("priority"), F.lit("Help Desk").alias("override_group")),
    )
    return (
        table(spark, sf_dir, "customer")
        .where((n % 250).isin(7, 8))
        .select(
            F.concat(F.lower("c_name"), F.lit("@example.org")).alias("okta_email"),
            F.inline(F.when(n % 250 == 7, twice).otherwise(once)),
        )
    )


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(
        workforce=check_columns(workforce(spark, sf_dir), "dim_workforce"),
        accounts=check_columns(accounts(spark, sf_dir), "okta_user"),
        schools=check_columns(schools(spark, sf_dir), "dim_school"),
        lookup=check_columns(lookup(spark, sf_dir), "looker_user_group"),
    )


SNAPSHOT_RULES = (
    Rule("Urgent", (is_("o_orderpriority", "1-URGENT"),)),
    Rule("Open ", (is_("o_orderstatus", "O"), like("o_orderpriority", "%medium", "%specified"))),
    Rule("Finished", (is_("o_orderstatus", "F"),)),
    Rule("Low", (like("o_orderpriority", "5-%"),)),
)


#: The older snapshot ends, the newer one begins here; in between orders are in both, and none is in neither.
PREVIOUS_UNTIL, CURRENT_SINCE = "1999-01-01", "1997-06-01"
PREVIOUS_PERIOD = f"o_orderdate < TIMESTAMP_NTZ '{PREVIOUS_UNTIL}'"
CURRENT_PERIOD = f"o_orderdate IS NULL OR o_orderdate >= TIMESTAMP_NTZ '{CURRENT_SINCE}'"


def orders_as_groups(spark: SparkSession, sf_dir: str, period: str) -> DataFrame:
    """Orders of a period as group assignments: several per key, some without key or group."""
    grouped = classify(table(spark, sf_dir, "orders").where(period), SNAPSHOT_RULES)
    return grouped.select(
        _unless(F.col("o_custkey") % 101 == 0, F.col("o_custkey").cast("string")).alias("workday_employee_number"),
        F.col("o_orderkey").cast("string").alias("okta_users_id"),
        "looker_user_group",
        F.date_trunc("year", F.col("o_orderdate")).cast("timestamp_ntz").alias("lst_updt_ts"),
        F.col("o_orderdate").alias("okta_hire_date"),
        F.lit("Current").alias("user_group_status"),
    )


def snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(previous, current)."""
    return orders_as_groups(spark, sf_dir, PREVIOUS_PERIOD), orders_as_groups(spark, sf_dir, CURRENT_PERIOD)
