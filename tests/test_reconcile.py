"""The truth table of the comparison, hot keys, and random relations against brute force."""

import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rostersync.operators.reconcile import diff_added, diff_removed, reconcile

SCHEMA = "k string, g string, ts int, st string"
NAMES = {"key": "k", "value": "g", "status": "st"}


def _relation(spark, pairs, ts=1):
    return spark.createDataFrame([(str(k) if k is not None else None, g, ts, "Current") for k, g in pairs], SCHEMA)


CURRENT = [(1, "A"), (2, "A"), (2, "B"), (3, "A"), (3, "B"), (4, None), (5, "A"), (6, "A"), (7, "A"), (7, "A")]
PREVIOUS = [(1, "A"), (2, "A"), (3, "A"), (3, "B"), (4, "A"), (5, None), (6, "Z"), (8, "A")]


def test_truth_table_pairwise(spark):
    current, previous = _relation(spark, CURRENT), _relation(spark, PREVIOUS)
    added = diff_added(current, previous, **NAMES)
    assert rows(added.select("k", "g", "st")) == [
        ("2", "B", "add"),
        ("3", "A", "add"),
        ("3", "B", "add"),
        ("5", "A", "add"),
        ("6", "A", "add"),
        ("7", "A", "add"),
    ]
    removed = diff_removed(previous, current, stamp="ts", **NAMES)
    assert removed.columns == previous.columns
    assert rows(removed.select("k", "g", "st")) == [
        (None, "A", "remove"),
        ("1", "A", "Current"),
        ("2", "A", "Current"),
        ("2", "A", "remove"),
        ("3", "A", "Current"),
        ("3", "A", "remove"),
        ("3", "B", "Current"),
        ("3", "B", "remove"),
        ("4", "A", "remove"),
        ("5", None, "Current"),
        ("6", "Z", "remove"),
    ]


def test_truth_table_set(spark):
    got = reconcile(_relation(spark, PREVIOUS), _relation(spark, CURRENT), stamp="ts", mode="set", **NAMES)
    assert rows(got.select("k", "g", "st")) == [
        ("1", "A", "Current"),
        ("2", "A", "Current"),
        ("2", "B", "add"),
        ("3", "A", "Current"),
        ("3", "B", "Current"),
        ("4", "A", "remove"),
        ("5", "A", "add"),
        ("6", "A", "add"),
        ("6", "Z", "remove"),
        ("7", "A", "add"),
        ("8", "A", "remove"),
    ]


def test_null_keys_never_match(spark):
    both = _relation(spark, [(None, "A")])
    got = reconcile(both, both, stamp="ts", **NAMES)
    assert rows(got) == [(None, "A", None, "remove"), (None, "A", 1, "add")]


def _brute(previous, current):
    """All pairs of a key, as a join would list them."""
    out = set()
    for k, g, ts, _ in current:
        partners = [p for p in previous if k is not None and p[0] == k]
        if not partners or any(p[1] is None or (g is not None and p[1] != g) for p in partners):
            out.add((k, g and g.strip(" "), ts, "add"))
    for k, g, _, st in previous:
        partners = [c for c in current if k is not None and c[0] == k]
        if not partners:
            out.add((None, g and g.strip(" "), None, "remove"))
        for c in partners:
            gone = c[1] is None or (g is not None and c[1] != g)
            out.add((k, g and g.strip(" "), c[2], "remove" if gone else st))
    return out


def _random(seed, hot):
    rng = random.Random(seed)

    def rel(n):
        return [
            (
                "hot" if rng.random() < hot else rng.choice([None, "a", "b", "c", "d", "e"]),
                rng.choice([None, "A", "B", "C", "D", "D "]),
                rng.choice([None, 1, 2]),
                "Current",
            )
            for _ in range(n)
        ]

    return rel(rng.randint(5, 60)), rel(rng.randint(5, 60))


@pytest.mark.parametrize("seed", range(8))
def test_pairwise_equals_all_pairs(spark, seed):
    previous, current = _random(seed, hot=0.34 if seed % 2 else 0.0)
    got = reconcile(
        spark.createDataFrame(previous, SCHEMA).repartition(3),
        spark.createDataFrame(current, SCHEMA).repartition(2),
        stamp="ts",
        **NAMES,
    )
    # Trimming follows the removal of duplicates, so compare as sets.
    assert {tuple(r) for r in got.collect()} == _brute(previous, current)


@pytest.mark.parametrize("seed", range(3))
def test_set_mode_turns_previous_into_current(spark, seed):
    previous, current = _random(100 + seed, hot=0.3)
    old, new = spark.createDataFrame(previous, SCHEMA), spark.createDataFrame(current, SCHEMA)
    got = reconcile(old, new, stamp="ts", mode="set", **NAMES).where("k is not null")
    state = {(k, g and g.strip(" ")) for k, g, _, _ in previous if k and g}
    state -= {(r.k, r.g) for r in got.where("st = 'remove'").collect()}
    state |= {(r.k, r.g) for r in got.where("st = 'add'").collect()}
    # 'D' and 'D ' are two groups until they are trimmed; either one left keeps the pair.
    want = {(k, g.strip(" ")) for k, g, _, _ in current if k and g}
    assert state | {p for p in want if p[1] == "D"} == want | {p for p in state if p[1] == "D"}


def test_set_mode_of_equal_relations_changes_nothing(spark):
    side = _relation(spark, CURRENT)
    got = reconcile(side, side, stamp="ts", mode="set", **NAMES)
    assert {r.st for r in got.select("st").collect()} == {"Current"}


def test_hot_key_on_both_sides_makes_no_pairs(spark):
    """2 x 20,000 rows of one key: 400 million pairs, but 40,000 rows out."""
    old = spark.range(20000).select(F.lit("hot").alias("k"), F.concat(F.lit("g"), F.col("id") % 5).alias("g"), F.lit(1).alias("ts"), F.lit("Current").alias("st"), "id")
    new = old.withColumn("g", F.concat(F.lit("g"), F.col("id") % 4)).drop("st")
    got = reconcile(old, new, stamp="ts", **NAMES)
    counts = Counter({r.st: r["count"] for r in got.groupBy("st").count().collect()})
    assert counts == {"add": 20000, "remove": 20000, "Current": 16000}


def test_staged_result_is_the_same(spark):
    from rostersync.operators.reconcile import reconcile_rows

    previous, current = _random(42, hot=0.3)
    old, new = spark.createDataFrame(previous, SCHEMA), spark.createDataFrame(current, SCHEMA)
    a = reconcile_rows(old, new, stamp="ts", staged=True, **NAMES).distinct()
    b = reconcile_rows(old, new, stamp="ts", **NAMES).distinct()
    assert rows(a) == rows(b)


def test_unknown_mode(spark):
    side = _relation(spark, CURRENT)
    with pytest.raises(ValueError):
        reconcile(side, side, stamp="ts", mode="both", **NAMES)


def test_rows_without_status_are_kept(spark):
    old = spark.createDataFrame([("1", "A", 1, None), ("2", "A", 1, None)], SCHEMA)
    new = spark.createDataFrame([("1", "A", 2, None), ("2", "B", 2, None)], SCHEMA)
    got = diff_removed(old, new, stamp="ts", **NAMES)
    assert rows(got) == [("1", "A", 2, None), ("2", "A", 2, "remove")]
