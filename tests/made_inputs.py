"""Small random inputs with NULLs, copies and hot keys, for Spark and DuckDB alike."""

from __future__ import annotations

import datetime as dt
import random

import pyarrow as pa

from rostersync.catalogue.standins import DEPARTMENTS, TITLES
from rostersync.sources.tables import Inputs

DAY = dt.date(2020, 1, 1)

WORKER = "worker_id string, business_title string, okta_department string, hire_date date, first_name string, last_name string, email_address string, company string, manager string, active string, original_hire_date date, termination_date date, lst_updt_ts timestamp_ntz"
ACCOUNT = "id string, employee_number string, lastupdated timestamp_ntz, display_name string, status string"
SCHOOL = "esd_school_name string, school_type_abbrev string, dwh_school_year_id int"
LOOKUP = "business_titles string, department_okta string, network_groups string"
OVERRIDE = "okta_email string, override_group string"


def make(seed: int, n: int = 120, hot: float = 0.0) -> dict[str, tuple[str, list[tuple]]]:
    """Table name (as the oracle calls it) -> (schema, rows). ``hot`` is the share of one number."""
    rng = random.Random(seed)

    def number():
        if rng.random() < hot:
            return "E0"
        return rng.choice([None] + [f"E{i}" for i in range(1, n // 2)])

    def day(span):
        return rng.choice([None] + [DAY + dt.timedelta(days=i) for i in range(span)])

    def stamp(span):
        d = day(span)
        return None if d is None else dt.datetime.combine(d, dt.time(rng.randrange(24)))

    names = ["Ann", "BOB", "Cy", None]
    workers = [
        (
            number(),
            rng.choice((*TITLES, None)),
            rng.choice((*DEPARTMENTS, None, None, None)),
            day(6),
            rng.choice(names),
            rng.choice(["Lee", "Ray", None]),
            f"p{rng.randrange(n)}@example.org",
            rng.choice(["SA North", "SA South - East", "West", None]),
            rng.choice(["ann.lee", "Bob.Ray", "cy.ray", "erin.example", "dan.example", None]),
            rng.choice(["Yes", "Yes", "No", None]),
            day(4),
            day(3),
            stamp(4),
        )
        for _ in range(n)
    ]
    workers += rng.sample(workers, n // 5)
    accounts = [
        (
            rng.choice([None] + [f"U{i}" for i in range(n)]),
            number(),
            stamp(5),
            rng.choice(["Ada Example", "Somebody", None]),
            rng.choice(["ACTIVE", "ACTIVE", "INACTIVE", None]),
        )
        for _ in range(n)
    ]
    accounts += rng.sample(accounts, n // 5)
    schools = [
        (name, rng.choice(["ES", "MS", "HS", "OT", None]), year)
        for name in ("North", "South-East", "West")
        for year in (15, 22, 3)
        for _ in range(rng.choice([1, 1, 2]))
    ]
    lookup = [
        (
            rng.choice(TITLES),
            rng.choice(["", "school", "S_pport", "fin", None, "%"]),
            rng.choice(["Team A", "Team B ", "Regional Operations Manager", None]),
        )
        for _ in range(60)
    ]
    overrides = [(f"p{i}@example.org", rng.choice(["Help Desk", "Team A"])) for i in range(0, n, 9)]
    return {
        "wf": (WORKER, workers),
        "acct": (ACCOUNT, accounts),
        "sch": (SCHOOL, schools),
        "lk": (LOOKUP, lookup),
        "ovr": (OVERRIDE, overrides),
    }


def to_spark(spark, made) -> tuple[Inputs, object]:
    frames = {name: spark.createDataFrame(rows, schema) for name, (schema, rows) in made.items()}
    return Inputs(frames["wf"], frames["acct"], frames["sch"], frames["lk"]), frames["ovr"]


def to_duck(con, made) -> None:
    kinds = {"string": pa.string(), "date": pa.date32(), "timestamp_ntz": pa.timestamp("us"), "int": pa.int32()}
    for name, (schema, rows) in made.items():
        fields = [c.split() for c in schema.split(", ")]
        arrow = pa.table(
            {c: pa.array([r[i] for r in rows], type=kinds[k]) for i, (c, k) in enumerate(fields)}
        )
        con.register(f"{name}_rows", arrow)
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_rows")
