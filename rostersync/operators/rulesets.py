"""The two rule sets, as data.

People are parameters: the defaults are invented and stand for a site's own lists.
"""

from __future__ import annotations

from dataclasses import dataclass

from rostersync.operators.rules import Rule, Condition, is_, like, unlike


@dataclass(frozen=True)
class People:
    """Who the older rules name. Managers are written ``first.last`` in lower case."""

    executives: tuple[str, ...] = ("Ada Example", "Ben Example", "Cleo Example", "Dan Example")
    science_managers: tuple[str, ...] = ("erin.example",)
    engineering_managers: tuple[str, ...] = (
        "finn.example",
        "gail.example",
        "hugo.example",
        "iris.example",
    )
    schooling_heads: tuple[str, ...] = ("dan.example",)


def _title(*patterns: str) -> Condition:
    return like("okta_title", *patterns)


def _dept(*values: str) -> Condition:
    return is_("okta_department", *values)


def _dept_like(*patterns: str) -> Condition:
    return like("okta_department", *patterns)


def _at_school(label: str, *tests: Condition, types: tuple[str, ...] = ("ES", "MS", "HS")) -> Rule:
    """A rule for staff of a school of one of the types; the label ends in the school's long name."""
    return Rule(label, (is_("school_type_abbrev", *types), *tests), suffix="school_model")


def _anywhere(label: str, *tests: Condition) -> Rule:
    return Rule(label, tests)


# Type code -> long name of a school.
SCHOOL_MODELS = {"ES": "Elementary School", "MS": "Middle School", "HS": "High School"}


def legacy_rules(people: People = People()) -> tuple[Rule, ...]:
    """The older set. Labels, patterns and departments, first match wins."""
    heads = ("%lead-%", "%leader-%", "%director%", "%executive%", "%head%")
    return (
        _at_school("Assessment", _dept("Support"), _title("assessment%")),
        _at_school("Assistant Principals", _dept_like("%school leadership%"), _title("%assistant principal%")),
        _at_school("School Leadership", _dept_like("%school leadership%"), _title("%senior leader%")),
        _at_school("Sprint", _dept("Support"), _title("%sprint%")),
        _at_school("Social Emotional & Psychologists", _dept("Support"), _title("%social emotional%", "%psychologist%")),
        _at_school("Business Operations Managers", _title("%business operations manager%")),
        _at_school("College Access & Guidance", _dept("Support"), _title("%college%"), types=("HS",)),
        _at_school("Arts and Athletics Teachers", _dept("Scholar Talent (Family Group)")),
        _at_school("School Operations", _dept("School Operations")),
        _anywhere("Executive Leadership", is_("display_name", *people.executives)),
        _anywhere("EDNA Data Science", _title("%data scien%"), _dept("Enterprise Services")),
        _anywhere("EDNA Data Science", is_("okta_manager", *people.science_managers), _dept("Enterprise Services")),
        _anywhere("EDNA Engineering & Analytics", is_("okta_manager", *people.engineering_managers)),
        _anywhere("EDNA Engineering & Analytics", _title("%ED&A%", "Enterprise Data & Analytics")),
        _anywhere("Family Care", _title("%family care%")),
        _anywhere("Family Engagement", _title("%family experience%", "%family engagement%")),
        _anywhere("Marketing", _title("%marketing%")),
        _anywhere("Operations Management", _title("%operations management%")),
        _anywhere("Regional Operations Manager (ROM)", _title("%regional operations manager%")),
        _anywhere("Content Design", _title("%content design%")),
        _anywhere("Learning Quality Management", _title("%learning quality%"), _title("%lead%", "manager")),
        _anywhere("Learning Quality", _title("%learning quality%")),
        _anywhere("School Management", _title("%school management%"), _title("%head%", "%leader%")),
        _anywhere("Edge Office", _title("%edge%")),
        _anywhere("Education Institute (EI) Leadership", _title("%EI Data%")),
        _anywhere("FP&A Leadership", _title("%chief%", "%head%"), _dept("Finance")),
        _anywhere("FP&A Management", _title("%lead%", "%manager%"), _dept("Finance")),
        _anywhere("Public Affairs Leadership", _title("%chief%", "%head%"), _dept("Public Affairs")),
        _anywhere("Public Affairs Management", _title("%lead%", "%manager%"), _dept("Public Affairs")),
        _anywhere("Education Institute (EI) Leadership", _title("%executive%", "%head%", "%lead%"), _dept("Education Institute")),
        _anywhere("Education Institute (EI) Management", _title("%director%", "%manager%"), _dept("Education Institute")),
        _anywhere("Schooling Leadership", _title(*heads), _dept("Schooling")),
        _anywhere("Schooling Leadership", _title(*heads), is_("okta_manager", *people.schooling_heads)),
        _anywhere("Schooling Management", _title("%manager%"), _dept("Schooling")),
        _anywhere("Technology Leadership", _title("%chief", "%lead"), _title("%technology%"), _dept("Enterprise Services")),
        _anywhere("Technology Management", _title("%manager%"), _title("%technology%"), _dept("Enterprise Services")),
        _anywhere("Technology Non-Management", _title("%technology%"), _dept("Enterprise Services")),
        _anywhere("Advancement", _dept("Advancement")),
        _anywhere("Advisory", _dept("Advisory")),
        _anywhere("Education Institute (EI) Non-Management", _dept("Education Institute")),
        _anywhere("FP&A Non-Management", _dept("Finance")),
        _anywhere("Human Capital", _dept("Human Capital")),
        _anywhere("Public Affairs Non-Management", _dept("Public Affairs")),
        _anywhere("Advancement", _dept("Advancement")),
        _anywhere("Schooling Non-Management", _dept("Schooling")),
    )


def current_rules() -> tuple[Rule, ...]:
    """The current set; the lookup's group is the default. Fixed values as above."""
    leadership = _dept_like("%school leadership%")
    return (
        _at_school("Assessment", _dept("Support"), _title("assessment%")),
        _at_school("Assistant Principals", leadership, _title("%assistant principal%")),
        _at_school("School Leadership", leadership, _title("%senior leader%", "%principal%")),
        _at_school("Associate Deans", leadership, _title("%associate dean%")),
        _at_school("Deans", leadership, _title("%dean%")),
        _at_school("Sprint", _dept("Support"), _title("%sprint%")),
        _at_school("Psychologists", _dept("Support"), _title("%psych%")),
        _at_school("Social Emotional Learning Specialists", _dept("Support"), _title("%social emotional%")),
        _at_school("Business Operations Managers", _title("%business operations manager%")),
        _at_school("College Access & Guidance", _dept("Support"), _title("%college%"), types=("HS",)),
        _at_school("Deans", leadership, _title("%Dean%")),
        _at_school("Robertson Leadership Fellow", leadership, _title("%Robertson Leadership Fellow%")),
        _at_school("School Operations", unlike("group_name", "%Regional Operations Manager%"), _dept_like("%school operations%")),
        _at_school("Registrar", _title("%Registrar%"), types=("HS",)),
    )
