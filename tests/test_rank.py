import random
from collections import defaultdict

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from rostersync.functions.ordering import descending
from rostersync.operators.rank import flag_latest, global_dense_rank, latest_with_ties, rank_latest


def _data(seed, n=600, hot=0.34):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rng.random() < hot else rng.choice([None, *"abcdefgh"])
        out.append((i, key, rng.choice([None, 1, 2, 3]), rng.choice([None, "x", "y"])))
    return out


SCHEMA = "i int, k string, a int, b string"


def _sort_key(row, nulls):
    def place(v):
        return (v is None, v) if nulls == "first" else (v is not None, v)

    return tuple((place(v)[0], "" if v is None else str(v)) for v in row[2:])


def _ranks(data, nulls, by_key):
    groups = defaultdict(set)
    for r in data:
        groups[r[1] if by_key else 0].add(_sort_key(r, nulls))
    order = {k: sorted(v, reverse=True) for k, v in groups.items()}
    return sorted((r[0], order[r[1] if by_key else 0].index(_sort_key(r, nulls)) + 1) for r in data)


@pytest.mark.parametrize("nulls", ["first", "last"])
@pytest.mark.parametrize("seed", [1, 2])
def test_latest_with_ties_is_rank_one(spark, nulls, seed):
    data = _data(seed)
    df = spark.createDataFrame(data, SCHEMA)
    expected = sorted(i for i, r in _ranks(data, nulls, True) if r == 1)
    for parts, staged in ((1, False), (7, True)):
        got = latest_with_ties(df.repartition(parts), ["k"], [F.col("a"), F.col("b")], nulls, staged=staged)
        assert sorted(r.i for r in got.collect()) == expected


def test_null_key_ranked_together_or_kept(spark):
    df = spark.createDataFrame([(None, 3), (None, 2), (1, 9), (1, 8)], "k int, v int")
    assert rows(latest_with_ties(df, ["k"], [F.col("v")])) == [(None, 3), (1, 9)]
    kept = latest_with_ties(df, ["k"], [F.col("v")], null_key="keep_all")
    assert rows(kept) == [(None, 2), (None, 3), (1, 9)]


def test_null_values_rank_first_by_default(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (2,)], "v int")
    assert rows(global_dense_rank(df, ["v"])) == [(None, 1), (1, 3), (2, 2), (2, 2)]
    assert rows(global_dense_rank(df, ["v"], nulls="last")) == [(None, 3), (1, 2), (2, 1), (2, 1)]


@pytest.mark.parametrize("strategy", ["auto", "distinct", "range"])
@pytest.mark.parametrize("nulls", ["first", "last"])
def test_ranks_agree_with_a_window(spark, strategy, nulls):
    df = spark.createDataFrame(_data(3), SCHEMA).repartition(5)
    order = descending([F.col("a"), F.col("b")], nulls)
    plain = df.select("i", F.dense_rank().over(Window.orderBy(*order)).cast("long"))
    got = global_dense_rank(df, ["a", "b"], nulls, strategy=strategy)
    assert rows(got.select("i", "rnk")) == rows(plain)
    per_key = df.select("i", F.dense_rank().over(Window.partitionBy("k").orderBy(*order)).cast("long"))
    got = rank_latest(df, ["k"], [F.col("a"), F.col("b")], nulls, strategy=strategy)
    assert rows(got.select("i", "rnk")) == rows(per_key)


def test_ranges_really_split_the_values(spark):
    df = spark.range(5000).select((F.col("id") % 1500).alias("v"))
    got = global_dense_rank(df, ["v"], strategy="range")
    assert got.where(F.col("rnk") != 1500 - F.col("v")).count() == 0
    assert got.count() == 5000


def test_too_many_values_for_one_task_are_refused(spark, monkeypatch):
    monkeypatch.setattr("rostersync.operators.rank.WINDOW_VALUES", 10)
    df = spark.range(50).withColumnRenamed("id", "v")
    for strategy in ("distinct", "auto"):
        got = global_dense_rank(df, ["v"], strategy=strategy)
        assert got.where(F.col("rnk") != 50 - F.col("v")).count() == 0


def test_flags_per_scope(spark):
    df = spark.createDataFrame(
        [("a", 1, "Yes"), ("a", 2, "No"), ("b", 1, "No"), (None, 5, "Yes"), (None, 5, None)], "k string, v int, act string"
    )
    got = flag_latest(df, ["k"], [F.col("v")], {"any": None, "active": F.col("act") == "Yes"})
    assert rows(got) == [
        (None, 5, None, True, False),
        (None, 5, "Yes", True, True),
        ("a", 1, "Yes", False, True),
        ("a", 2, "No", True, False),
        ("b", 1, "No", True, False),
    ]


def test_latest_never_windows_a_key(spark):
    df = spark.createDataFrame(_data(4, 20), SCHEMA)
    plan = latest_with_ties(df, ["k"], [F.col("a")])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_bad_arguments(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError):
        latest_with_ties(df, ["k"], [F.col("v")], null_key="drop")
    with pytest.raises(ValueError):
        global_dense_rank(df, ["v"], nulls="middle")
    with pytest.raises(ValueError):
        global_dense_rank(df, ["v"], strategy="naive")


def test_hot_null_key_is_split_by_adaptive_execution(spark, settings):
    """A third of the rows without a key, all tied: the comparing join is split, no task gets them all."""
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="2KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="4KB",
    )
    df = spark.range(0, 60000, 1, 8).select(
        "id", F.when(F.col("id") % 3 != 0, F.concat(F.lit("k"), F.col("id") % 1000)).alias("k"), F.lit(1).alias("v")
    )
    got = latest_with_ties(df, ["k"], [F.col("v")])
    assert len(got.collect()) == 60000
    assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()


def test_ranges_are_numbered_where_they_are_sorted(spark):
    """One exchange, by range; rows are numbered without another one."""
    from rostersync.operators.rank import _number_by_range

    values = spark.range(0, 5000, 1, 7).select(F.xxhash64("id").alias("v")).distinct()
    ranked = _number_by_range(values, [F.col("v").desc()], "rnk")
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "Window [row_number" not in plan and "hashpartitioning(__range" not in plan.replace("partial_count", "").split("BroadcastExchange")[0]
    got = [r["rnk"] for r in ranked.orderBy(F.desc("v")).collect()]
    assert got == list(range(1, 5001))
