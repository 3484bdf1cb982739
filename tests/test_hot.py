"""Hot keys from a sketch, and joins that share the list."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rostersync.operators.hot import REPORTED, HotKeys, hot_keys
from rostersync.operators.joins import attach_many, join_identity


@pytest.mark.parametrize("partitions", [1, 90])
def test_every_hot_key_is_found_and_no_other(spark, partitions):
    i = F.col("id")
    key = F.when(i % 3 == 0, "third").when(i % 10 == 1, "tenth").when(i % 50 == 2, None).otherwise(i.cast("string"))
    df = spark.range(0, 300_000, 1, partitions).select(key.alias("k"))
    found = dict(hot_keys(df, F.col("k"), 10_000, tracked=1_000).counts)
    exact = {r["k"]: r["count"] for r in df.where("k IS NOT NULL").groupBy("k").count().where("count > 10000").collect()}
    assert set(found) == set(exact) == {"third", "tenth"}
    assert all(abs(found[k] - n) <= 4 * 300_000 / 1_000 for k, n in exact.items())


def test_list_is_bounded_and_may_be_empty(spark):
    many = spark.range(50_000).select((F.col("id") % 5_000).alias("k"))
    assert len(hot_keys(many, F.col("k"), 1).counts) <= REPORTED
    assert hot_keys(many.limit(0), F.col("k"), 1).counts == ()
    assert hot_keys(many.select(F.lit(None).alias("k")), F.col("k"), 1).counts == ()


def test_no_key_is_shuffled(spark):
    """What is exchanged are sketches: a row for each part and task."""
    df = spark.range(0, 100_000, 1, 8).select(F.col("id").alias("k"))
    rows = df.select(F.col("k").cast("string").alias("k"), F.pmod(F.spark_partition_id(), F.lit(64)).alias("part"))
    plan = rows.groupBy("part").agg(F.expr("approx_top_k_accumulate(k, 1000)"))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_approx_top_k_accumulate") > plan.index("Exchange hashpartitioning(part")


@pytest.mark.parametrize("counts", [(), (("hot", 140),), (("hot", 140), ("k3", 9), ("absent", 50))])
@pytest.mark.parametrize("staged", [False, True])
def test_joins_do_not_depend_on_the_list(spark, counts, staged):
    rng = random.Random(7)
    left = [(i, "hot" if rng.random() < 0.3 else rng.choice([None, *[f"k{j}" for j in range(30)]])) for i in range(300)]
    right = [("hot" if rng.random() < 0.3 else rng.choice([None, *[f"k{j}" for j in range(30)]]), i) for i in range(300)]
    want = Counter()
    for i, k in left:
        want.update([(i, k, v) for kk, v in right if k is not None and kk == k] or [(i, k, None)])
    got = attach_many(
        spark.createDataFrame(left, "i int, k string").repartition(4), spark.createDataFrame(right, "key string, v int").repartition(3),
        {"k": "key"}, hot_rows=5, salts=3, staged=staged, hot_list=HotKeys(counts),
    )
    assert Counter(map(tuple, got.collect())) == want


def test_unstaged_joins_hint_no_broadcast(spark):
    workers = spark.createDataFrame([("1",)], "worker_id string")
    accounts = spark.createDataFrame([("1", "a")], "employee_number string, id string")
    joined = join_identity(workers, accounts, hot_rows=1)
    assert "strategy=broadcast" not in joined._jdf.queryExecution().logical().toString()
    assert [tuple(r) for r in joined.collect()] == [("1", "a")]
