import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rostersync.operators.aggregate import single_valued
from rostersync.operators.joins import (
    attach,
    attach_many,
    exists_flag,
    join_identity,
    join_lookup,
    with_active_account,
)
from rostersync.operators.sets import union_all, union_distinct
from rostersync.session import partitions_for
from rostersync.operators.staging import broadcast_if_small, is_small, materialise, staging_dir


def _left_join(left, right):
    out = Counter()
    for i, k in left:
        hits = [v for kk, v in right if kk is not None and kk == k]
        out.update([(i, k, v) for v in hits] or [(i, k, None)])
    return out


def _skewed(seed, left_rows=400, right_rows=300):
    rng = random.Random(seed)

    def key():
        return "hot" if rng.random() < 0.35 else rng.choice([None, *[f"k{i}" for i in range(60)]])

    return [(i, key()) for i in range(left_rows)], [(key(), i) for i in range(right_rows)]


@pytest.mark.parametrize("hot_rows, salts", [(10**6, 64), (5, 4), (1, 16), (50, 1)])
def test_attach_many_is_a_left_join_whatever_is_hot(spark, hot_rows, salts):
    left, right = _skewed(7)
    got = attach_many(
        spark.createDataFrame(left, "i int, k string").repartition(4),
        spark.createDataFrame(right, "key string, v int").repartition(3),
        {"k": "key"},
        hot_rows,
        salts,
    )
    assert got.columns == ["i", "k", "v"]
    assert Counter(tuple(r) for r in got.collect()) == _left_join(left, right)


def test_attach_many_with_copies_and_two_keys(spark):
    left = [(1, "a", 1), (1, "a", 1), (2, "a", None), (3, None, 1), (4, "b", 2)]
    right = [("a", 1, "x")] * 5 + [("b", 2, "y"), ("b", 2, "z"), (None, 1, "w"), ("c", 1, "v")]
    got = attach_many(
        spark.createDataFrame(left, "i int, k string, m int"),
        spark.createDataFrame(right, "rk string, rm int, v string"),
        {"k": "rk", "m": "rm"},
        hot_rows=2,
        salts=8,
    )
    expected = Counter({(1, "a", 1, "x"): 10, (2, "a", None, None): 1, (3, None, 1, None): 1, (4, "b", 2, "y"): 1, (4, "b", 2, "z"): 1})
    assert Counter(tuple(r) for r in got.collect()) == expected


def test_hot_right_key_is_spread_over_tasks(spark, settings):
    """Without broadcast of the sides, no task of the join sees more than its share of the hot key."""
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1", adaptive__coalescePartitions__enabled="false")
    left = spark.createDataFrame([(1, "hot"), (2, "cold")], "i int, k string")
    right = spark.range(4000).select(F.lit("hot").alias("key"), F.col("id").alias("v"))
    got = attach_many(left, right, {"k": "key"}, hot_rows=100, salts=64)
    assert got.count() == 4001
    tasks = got.where("i = 1").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in tasks) == 4000
    assert len(tasks) > 4 and max(r["count"] for r in tasks) < 2000


def test_attach_spreads_null_keys(spark, settings):
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1", adaptive__coalescePartitions__enabled="false")
    left = spark.range(4000).select("id", F.lit(None).cast("string").alias("k"))
    right = spark.createDataFrame([("a", 1)], "key string, v int")
    got = attach(left, right, {"k": "key"})
    tasks = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in tasks) == 4000
    assert len(tasks) > 4 and max(r["count"] for r in tasks) < 2000


def test_hot_left_key_is_split_by_adaptive_execution(spark, settings):
    """An aggregate on the join key gets an exchange of its own, so the skewed side can be split."""
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="2KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="4KB",
    )
    left = spark.range(0, 60000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 1000)).alias("k")
    )
    right = left.groupBy(F.col("k").alias("key")).agg(F.count("*").alias("n"))
    got = attach(left, right, {"k": "key"})
    got.write.format("noop").mode("overwrite").save()
    out = got.collect()
    assert len(out) == 60000 and all(r.n == 20000 for r in out if r.k == "hot")
    assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()


def test_attach_null_safe(spark):
    left = spark.createDataFrame([(1, "a", None), (2, "a", 3), (3, None, None)], "i int, k string, m int")
    right = spark.createDataFrame([("a", None, "x"), (None, None, "y")], "rk string, rm int, v string")
    got = attach(left, right, {"k": "rk", "m": "rm"}, null_safe=["m"])
    assert rows(got) == [(1, "a", None, "x"), (2, "a", 3, None), (3, None, None, None)]


def test_identity_join_compares_text(spark):
    workers = spark.createDataFrame([(7, "n"), (None, "m"), (12, "o")], "worker_id bigint, name string")
    accounts = spark.createDataFrame([("7", "u1"), ("007", "u2"), (None, "u3")], "employee_number string, id string")
    assert rows(join_identity(workers, accounts)) == [(None, "m", None), (12, "o", None), (7, "n", "u1")]
    loose = join_identity(workers, accounts, strip_zeros=True)
    assert rows(loose) == [(None, "m", None), (12, "o", None), (7, "n", "u1"), (7, "n", "u2")]


def test_active_account_does_not_fan_out(spark):
    workers = spark.createDataFrame([("1",), ("1",), ("2",), ("3",), (None,)], "worker_id string")
    accounts = spark.createDataFrame(
        [("1", "ACTIVE"), ("1", "ACTIVE"), ("2", "INACTIVE"), (None, "ACTIVE")], "employee_number string, status string"
    )
    assert rows(with_active_account(workers, accounts)) == [("1",), ("1",)]


def test_lookup_join_fans_out_and_keeps_unmatched(spark):
    df = spark.createDataFrame([("T", "Big Dept"), ("t", "Big Dept"), ("T", None)], "okta_title string, okta_department string")
    lookup = spark.createDataFrame(
        [("T", "big", "G1"), ("T", "", "G2"), ("T", None, "G3"), ("T", "small", "G4")],
        "title string, department string, group_name string",
    )
    got = rows(join_lookup(df, lookup).select("okta_title", "okta_department", "group_name"))
    assert got == [("T", None, None), ("T", "Big Dept", "G1"), ("T", "Big Dept", "G2"), ("t", "Big Dept", None)]


def test_exists_flag_never_fans_out(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    keys = spark.createDataFrame([("a",), ("a",), (None,)], "g string")
    assert rows(exists_flag(df, keys, {"k": "g"}, "hit")) == [(None, False), ("a", True), ("b", False)]


def test_single_valued(spark):
    data = [("a", "x"), ("a", "x"), ("b", "x"), ("b", "y"), ("c", None), ("d", "z"), ("d", None), (None, "q")]
    assert rows(single_valued(spark.createDataFrame(data, "k string, v string"), "k", "v")) == [("a", "x"), ("d", "z")]


def test_set_operations(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "i int, s string")
    assert union_all(a, a).count() == 6
    assert rows(union_distinct(a, a)) == [(1, None), (2, "x")]
    with pytest.raises(ValueError):
        union_all(a, a.select("s", "i"))


def test_staging(spark, settings):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, s string")
    stored = materialise(df, "t")
    assert rows(stored) == [(1, "a"), (2, None)] and stored.schema == df.schema
    assert stored.inputFiles()[0].removeprefix("file:").lstrip("/").startswith(staging_dir(spark).removeprefix("file:").lstrip("/"))
    assert is_small(df, rows=2) and not is_small(df, rows=1) and not is_small(df, size=1)
    big = spark.range(1000)
    assert "broadcast" not in broadcast_if_small(big, rows=10)._jdf.queryExecution().logical().toString().lower()


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace as Fake

    def session(master, named):
        return Fake(
            conf=Fake(get=lambda key, default=None: named),
            sparkContext=Fake(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda path: None),
        )

    assert staging_dir(session("spark://host", "s3://shared/")) == "s3://shared"
    with pytest.raises(RuntimeError):
        staging_dir(session("spark://host", None))
    assert staging_dir(session("local[2]", None))


def test_partitions_follow_the_input():
    assert partitions_for(1) == 200
    assert partitions_for(10**12) == 4968
    assert partitions_for(100 * 10**12) == 50_000
