from conftest import rows
from pyspark.sql import functions as F

from rostersync.functions.text import matches_part, name_key, normalise_company, rewrite_title, text_key


def _one(spark, value, build):
    return spark.createDataFrame([(value,)], "a string").select(build(F.col("a"))).first()[0]


def test_company_loses_every_token_or_the_prefix_only(spark):
    assert _one(spark, "SA Foo - Bar", normalise_company) == "Foo-Bar"
    assert _one(spark, "SA Foo SA Bar", normalise_company) == "Foo Bar"
    assert _one(spark, "SA Foo SA Bar", lambda c: normalise_company(c, prefix_only=True)) == "Foo SA Bar"
    assert _one(spark, "USA Foo", lambda c: normalise_company(c, prefix_only=True)) == "USA Foo"
    assert _one(spark, None, normalise_company) is None


def test_title_rewriting(spark):
    assert _one(spark, "Lead, Maths, Senior,x", rewrite_title) == "Lead--Maths--Senior,x"


def test_name_key_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("Ann", "Lee"), (None, "Lee"), ("Ann", None)], "f string, l string")
    assert rows(df.select(name_key(F.col("f"), F.col("l")))) == [(None,), (None,), ("ann.lee",)]


def test_identifiers_compare_as_text(spark):
    df = spark.createDataFrame([("007", 7), ("0", 0), ("A12", 12), (None, None)], "a string, b int")
    plain = df.where(text_key(F.col("a")) == text_key(F.col("b"))).collect()
    assert [r.a for r in plain] == ["0"]
    bare = df.select(text_key(F.col("a"), strip_zeros=True)).collect()
    assert [r[0] for r in bare] == ["7", "0", "A12", None]


def test_patterns_from_data(spark):
    cases = [
        ("AXB", "a_", True, False),
        ("x", "", True, True),
        ("x", None, None, None),
        (None, "", None, None),
        ("50% off", "0%O", True, False),
        ("a\\b", "\\B", True, True),
        ("ab", "\\", False, False),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "t string, p string")
    got = df.select(
        matches_part(F.col("t"), F.col("p")), matches_part(F.col("t"), F.col("p"), literal=True)
    ).collect()
    assert [tuple(r) for r in got] == [c[2:] for c in cases]
