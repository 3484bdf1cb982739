"""One row per rule that fires it, and the order of rules."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rostersync.operators.gates import Gate, gated
from rostersync.operators.joins import join_lookup, join_lookup_distinct
from rostersync.operators.rules import (
    Condition,
    Rule,
    classify,
    classify_distinct,
    is_,
    like,
    repeated_rules,
    rule_inputs,
    unlike,
)
from rostersync.operators.staging import materialise
from rostersync.operators.rulesets import People, current_rules, legacy_rules

SCHEMA = (
    "okta_title string, okta_department string, school_type_abbrev string, school_model string, "
    "okta_manager string, display_name string, group_name string"
)
HS = ("HS", "High School")
NONE = (None, None)


def _groups(spark, people, rules, default=None):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(people)], "i int, " + SCHEMA)
    return [r.looker_user_group for r in classify(df, rules, default).orderBy("i").collect()]


def _person(title, department=None, school=NONE, manager=None, name=None, group=None):
    return (title, department, *school, manager, name, group)


LEGACY = [
    (_person("ASSESSMENT lead", "Support", HS), "Assessment (High School)"),
    (_person("An Assistant Principal", "x School Leadership", HS), "Assistant Principals (High School)"),
    (_person("senior leader", "school leadership", HS), "School Leadership (High School)"),
    (_person("sprint", "Support", HS), "Sprint (High School)"),
    (_person("psychologist", "Support", HS), "Social Emotional & Psychologists (High School)"),
    (_person("social emotional", "Support", HS), "Social Emotional & Psychologists (High School)"),
    (_person("business operations manager", None, HS), "Business Operations Managers (High School)"),
    (_person("college", "Support", HS), "College Access & Guidance (High School)"),
    (_person("x", "Scholar Talent (Family Group)", HS), "Arts and Athletics Teachers (High School)"),
    (_person("x", "School Operations", HS), "School Operations (High School)"),
    (_person("x", name="Ben Example"), "Executive Leadership"),
    (_person("Data Scientist", "Enterprise Services"), "EDNA Data Science"),
    (_person("x", "Enterprise Services", manager="erin.example"), "EDNA Data Science"),
    (_person("x", manager="hugo.example"), "EDNA Engineering & Analytics"),
    (_person("of ed&a x"), "EDNA Engineering & Analytics"),
    (_person("enterprise data & analytics"), "EDNA Engineering & Analytics"),
    (_person("family care"), "Family Care"),
    (_person("family experience"), "Family Engagement"),
    (_person("family engagement"), "Family Engagement"),
    (_person("marketing"), "Marketing"),
    (_person("operations management"), "Operations Management"),
    (_person("regional operations manager"), "Regional Operations Manager (ROM)"),
    (_person("content design"), "Content Design"),
    (_person("learning quality lead"), "Learning Quality Management"),
    (_person("learning quality"), "Learning Quality"),
    (_person("learning quality manager"), "Learning Quality"),
    (_person("head of school management"), "School Management"),
    (_person("knowledge"), "Edge Office"),
    (_person("ei data"), "Education Institute (EI) Leadership"),
    (_person("chief", "Finance"), "FP&A Leadership"),
    (_person("manager", "Finance"), "FP&A Management"),
    (_person("head", "Public Affairs"), "Public Affairs Leadership"),
    (_person("lead", "Public Affairs"), "Public Affairs Management"),
    (_person("executive", "Education Institute"), "Education Institute (EI) Leadership"),
    (_person("director", "Education Institute"), "Education Institute (EI) Management"),
    (_person("lead--maths", "Schooling"), "Schooling Leadership"),
    (_person("leader--maths", manager="dan.example"), "Schooling Leadership"),
    (_person("manager", "Schooling"), "Schooling Management"),
    (_person("technology lead", "Enterprise Services"), "Technology Leadership"),
    (_person("technology manager", "Enterprise Services"), "Technology Management"),
    (_person("lead technology staff", "Enterprise Services"), "Technology Non-Management"),
    (_person("x", "Advancement"), "Advancement"),
    (_person("x", "Advisory"), "Advisory"),
    (_person("x", "Education Institute"), "Education Institute (EI) Non-Management"),
    (_person("x", "Finance"), "FP&A Non-Management"),
    (_person("x", "Human Capital"), "Human Capital"),
    (_person("x", "Public Affairs"), "Public Affairs Non-Management"),
    (_person("x", "Schooling"), "Schooling Non-Management"),
    (_person("x", "finance"), None),
    (_person("x"), None),
]


def test_each_legacy_rule_fires(spark):
    got = _groups(spark, [p for p, _ in LEGACY], legacy_rules())
    assert got == [g for _, g in LEGACY]
    fired = {g for g in got if g}
    assert {r.label for r in legacy_rules()} <= {g.replace(" (High School)", "") for g in fired}


CURRENT = [
    (_person("assessment", "Support", HS), "Assessment (High School)"),
    (_person("assistant principal", "School Leadership", HS), "Assistant Principals (High School)"),
    (_person("principal", "School Leadership", HS), "School Leadership (High School)"),
    (_person("senior leader", "School Leadership", HS), "School Leadership (High School)"),
    (_person("associate dean", "School Leadership", HS), "Associate Deans (High School)"),
    (_person("DEAN", "School Leadership", HS), "Deans (High School)"),
    (_person("sprint", "Support", HS), "Sprint (High School)"),
    (_person("psych", "Support", HS), "Psychologists (High School)"),
    (_person("social emotional", "Support", HS), "Social Emotional Learning Specialists (High School)"),
    (_person("business operations manager", None, HS), "Business Operations Managers (High School)"),
    (_person("college", "Support", HS), "College Access & Guidance (High School)"),
    (_person("robertson leadership fellow", "School Leadership", HS), "Robertson Leadership Fellow (High School)"),
    (_person("x", "School Operations", HS, group="Team"), "School Operations (High School)"),
    (_person("x", "School Operations", HS, group="regional operations manager 3"), "regional operations manager 3"),
    (_person("x", "School Operations", HS, group=None), None),
    (_person("registrar", None, HS), "Registrar (High School)"),
    (_person("registrar", None, ("ES", "Elementary School"), group="Team"), "Team"),
    (_person("x", group="Team "), "Team "),
    (_person("x"), None),
]


def test_each_current_rule_fires(spark):
    got = _groups(spark, [p for p, _ in CURRENT], current_rules(), "group_name")
    assert got == [g for _, g in CURRENT]


@pytest.mark.parametrize("rules, default", [(legacy_rules(), None), (current_rules(), "group_name")])
def test_first_match_wins(spark, rules, default):
    """A person built to pass a rule gets that rule's label, or an earlier rule's they also pass."""
    columns = [c.split()[0] for c in SCHEMA.split(", ")]

    def passing(rule):
        person = dict.fromkeys(columns)
        person["school_model"] = "M"
        person["group_name"] = "G"
        for t in rule.tests:
            if t.op == "unlike":
                continue
            word = t.values[0].strip("%")
            held = person[t.column]
            if t.column == "group_name" or held is None:
                person[t.column] = word
            else:
                person[t.column] = f"{held} {word}"
        return person

    def passes(rule, person):
        def one(t: Condition):
            text = person[t.column]
            if text is None:
                return False
            if t.op == "is":
                return text in t.values

            def hit(pattern):
                p, s = pattern.lower(), text.lower()
                core = p.strip("%")
                if p.startswith("%") and p.endswith("%"):
                    return core in s
                if p.startswith("%"):
                    return s.endswith(core)
                return s.startswith(core) if p.endswith("%") else s == core

            hits = [hit(v) for v in t.values]
            return any(hits) if t.op == "like" else not any(hits)

        return all(one(t) for t in rule.tests)

    people = [passing(r) for r in rules]
    expected = []
    for person in people:
        first = next((r for r in rules if passes(r, person)), None)
        label = person["group_name"] if default else None
        if first is not None:
            label = f"{first.label} (M)" if first.suffix else first.label
        expected.append(label)
    got = _groups(spark, [tuple(p[c] for c in columns) for p in people], rules, default)
    assert got == expected


def test_repeated_rules_are_the_two_known_ones():
    assert [legacy_rules()[i].label for i in repeated_rules(legacy_rules())] == ["Advancement"]
    assert [current_rules()[i].label for i in repeated_rules(current_rules())] == ["Deans"]
    assert len(legacy_rules()) == 45 and len(current_rules()) == 14


def test_people_are_parameters(spark):
    rules = legacy_rules(People(executives=("Zed Other",)))
    assert _groups(spark, [_person("x", name="Zed Other"), _person("x", name="Ben Example")], rules) == [
        "Executive Leadership",
        None,
    ]


def test_null_fails_every_test(spark):
    rules = (Rule("is", (is_("a", "x"),)), Rule("like", (like("a", "%"),)), Rule("unlike", (unlike("a", "q%", "r%"),)))
    df = spark.createDataFrame([(None,), ("x",), ("y",)], "a string")
    assert [r.g for r in classify(df, rules, name="g").collect()] == [None, "is", "like"]
    only = classify(df, rules[2:], name="g").where(F.col("g").isNull()).collect()
    assert [r.a for r in only] == [None]


def test_no_python_and_one_stage(spark):
    df = spark.createDataFrame([_person("x")], SCHEMA)
    plan = classify(df, legacy_rules())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    # Lowered once per text column, not once per rule.
    assert plan.count("lower(okta_title") == 1


def test_unknown_test_is_refused():
    with pytest.raises(ValueError):
        Condition("a", "matches", ("x",))


def test_generated_methods_stay_small_enough_to_be_compiled(spark):
    import re

    df = materialise(spark.createDataFrame([_person("x")] * 3, SCHEMA))
    for rules, default in ((legacy_rules(), None), (current_rules(), "group_name")):
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        text = classify(df, rules, default)._jdf.queryExecution().explainString(mode)
        assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text))) < 8000


def test_filter_on_the_group_does_not_copy_the_rules(spark):
    df = materialise(spark.createDataFrame([_person("assessment lead", "Support", HS), _person("x")], SCHEMA))
    kept = classify(df, legacy_rules()).where(F.col("looker_user_group").isNotNull())
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("StartsWith(") == 1
    assert kept.count() == 1


RANDOM_RULES = (
    Rule("One", (like("a", "%x%"), unlike("b", "%q%")), suffix="c"),
    Rule("Two", (is_("b", "m", "n"),)),
    Rule("Three", (like("c", "y_", "%%"), like("a", "%")), suffix="c"),
)


@pytest.mark.parametrize("default", [None, "d"])
@pytest.mark.parametrize("small", [True, False])
def test_distinct_inputs_give_the_same_groups(spark, monkeypatch, default, small):
    rng = random.Random(4)
    draw = lambda: rng.choice([None, "", "x", "xq", "m", "n", "Y1", "y2"])
    data = [(i, draw(), draw(), draw(), draw()) for i in range(400)] * 2
    df = spark.createDataFrame(data, "i int, a string, b string, c string, d string").repartition(5)
    if not small:
        monkeypatch.setattr("rostersync.operators.rules.is_small", lambda _: False)
    assert rule_inputs(RANDOM_RULES, default) == ["a", "b", "c", *([default] if default else [])]
    for rows_ in (df, df.withColumn("looker_user_group", F.lit("old"))):
        got, want = classify_distinct(rows_, RANDOM_RULES, default), classify(rows_, RANDOM_RULES, default)
        assert got.columns == want.columns
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_rules_run_on_distinct_inputs_only(spark):
    """The written tuples are as many as there are combinations, and the rules stand above them."""
    df = spark.range(2000).select((F.col("id") % 3).cast("string").alias("a"), F.lit("m").alias("b"), F.lit(None).cast("string").alias("c"))
    with gated([Gate("rule-inputs", "rows", least=4)], stop=False) as watch:
        classify_distinct(df, RANDOM_RULES).collect()
    assert [o.violations for o in watch.outcomes] == [1]


def test_distinct_lookups_give_the_same_matches(spark):
    rng = random.Random(6)
    data = [(i, rng.choice([None, "T1", "T2", "T3"]), rng.choice([None, "", "Legal", "School Ops", "a_b", "50%"])) for i in range(300)]
    df = spark.createDataFrame(data, "i int, okta_title string, okta_department string")
    lookup = spark.createDataFrame(
        [(f"T{j % 3}", p, f"g{j}") for j, p in enumerate(["", "legal", "l_g", "%", None, "a\\_b", "SCHOOL%ops", "x"] * 3)],
        "title string, department string, group_name string",
    )
    for literal in (False, True):
        got, want = join_lookup_distinct(df, lookup, literal=literal), join_lookup(df, lookup, literal=literal)
        assert got.columns == want.columns
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
