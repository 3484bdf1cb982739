"""Gates measured while relations are written, run folders, and published versions."""

import os
from collections import Counter
from pathlib import Path

import pytest
from conftest import rows
from made_inputs import make, to_spark
from pyspark.sql import functions as F

from rostersync.operators import staging
from rostersync.operators.checks import CheckFailed
from rostersync.operators.files import Files
from rostersync.operators.gates import Gate, gated
from rostersync.operators.staging import check_shared, materialise, run_folder
from rostersync.plans import assign
from rostersync.sources.sinks import current_manifest, publish, read_published


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1, "a"), (2, None), (2, "c"), (None, "d"), (None, "d")], "i int, s string")


GATES = {
    Gate("x", "not_null", ("i", "s")): 3,
    Gate("x", "not_null", ("s",)): 1,
    Gate("x", "unique", ("i",)): 1,
    Gate("x", "unique", ("i", "s")): 0,
    Gate("x", "accepted", ("s",), ("a", "c")): 2,
    Gate("x", "accepted", ("i",), (1, 2)): 0,
    Gate("x", "rows", least=5): 0,
    Gate("x", "rows", least=7): 2,
    Gate("x", "holds", test="i < 2"): 2,
}


def test_violations_are_counted(df):
    with gated(GATES, stop=False) as watch:
        materialise(df, "x")
        materialise(df, "another")
    assert {o.gate: o.violations for o in watch.outcomes} == GATES


@pytest.mark.parametrize("gate", GATES, ids=lambda g: g.name)
def test_a_broken_gate_stops(df, gate):
    with gated([gate]) as watch:
        if GATES[gate]:
            with pytest.raises(CheckFailed, match=gate.kind):
                materialise(df, "x")
        else:
            assert materialise(df, "x").count() == 5
    assert [o.violations for o in watch.outcomes] == [GATES[gate]]


def test_empty_relations_break_only_row_counts(df):
    with gated(GATES, stop=False) as watch:
        materialise(df.limit(0), "x")
        materialise(df.where("false"), "x")
    assert {o.gate.name for o in watch.outcomes if o.violations} == {"x: rows >= 5", "x: rows >= 7"}


def test_inner_gates_come_on_top(df):
    with gated([Gate("x", "rows", least=9)], stop=False) as outer:
        with gated([Gate("x", "unique", ("i",))], stop=False):
            materialise(df, "x")
    assert [(o.gate.kind, o.violations) for o in outer.outcomes] == [("rows", 4), ("unique", 1)]
    with pytest.raises(ValueError, match="unknown gate"):
        Gate("x", "positive")


def test_row_gates_add_no_job(spark, df):
    """The write is one job, gates or not."""

    def jobs(gates):
        group = os.urandom(8).hex()
        spark.sparkContext.setJobGroup(group, group)
        with gated(gates, stop=False):
            materialise(df, "x")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs([g for g in GATES if g.kind != "unique"]) == jobs([])


def test_run_folder_goes_with_the_run(spark, df):
    files = Files(spark)
    with run_folder(spark) as folder:
        again = materialise(df, "kept")
        assert again.count() == 5 and files.exists(folder.path)
        assert [w["label"] for w in folder.written] == ["kept"]
    assert not files.exists(folder.path)
    with pytest.raises(RuntimeError, match="broken"), run_folder(spark) as folder:
        materialise(df, "kept")
        raise RuntimeError("broken")
    assert not files.exists(folder.path)
    assert materialise(df, "outside").count() == 5


def test_publish_replaces_at_once_and_cleans_up(spark, df, tmp_path):
    target = f"{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        read_published(spark, target)
    assert rows(publish(df.limit(1), target)) == [(1, "a")]
    publish(df, target, {"why": "test"})
    assert read_published(spark, target).count() == 5 and read_published(spark, target).schema == df.schema
    assert current_manifest(spark, target)["notes"] == {"why": "test"}
    assert len(os.listdir(f"{target}/versions")) == 1 and len(Files(spark).names(f"{target}/manifests")) == 1
    publish(df.limit(2), target, keep=2)
    assert len(os.listdir(f"{target}/versions")) == 2 and read_published(spark, target).count() == 2


def test_a_failed_publication_leaves_the_old_version(spark, df, tmp_path):
    target = f"{tmp_path}/t"
    publish(df, target)
    with pytest.raises(Exception, match="no good"):
        publish(df.withColumn("i", F.raise_error(F.lit("no good")).cast("int")), target)
    assert read_published(spark, target).count() == 5
    # What it left is dropped by the next one.
    publish(df.limit(1), target)
    assert len(os.listdir(f"{target}/versions")) == 1


def test_a_number_is_published_once(spark, tmp_path):
    files = Files(spark)
    files.write_new(f"{tmp_path}/m/1.json", "one")
    with pytest.raises(FileExistsError):
        files.write_new(f"{tmp_path}/m/1.json", "two")
    assert files.read(f"{tmp_path}/m/1.json") == "one" and files.names(f"{tmp_path}/m") == ["1.json"]


def test_a_folder_that_tasks_do_not_see_is_refused(spark, tmp_path, monkeypatch):
    check_shared(spark, f"file://{tmp_path}")
    monkeypatch.setattr(staging.Files, "local_name", lambda self, path: "/nowhere/at/all")
    with pytest.raises(RuntimeError, match="is not shared"):
        check_shared(spark, f"file://{tmp_path}")
    assert [n for n in os.listdir(tmp_path) if not n.startswith(".")] == []


def _staged(spark):
    top = Path(staging.staging_dir(spark).removeprefix("file:")) / spark.sparkContext.applicationId
    return {str(p) for p in top.iterdir()} if top.exists() else set()


def test_run_and_publish(spark, tmp_path):
    inputs, overrides = to_spark(spark, make(31, 60, 0.2))
    config, target = assign.Config(overrides=overrides), f"{tmp_path}/mart"
    want = Counter(map(tuple, assign.run(inputs, config).collect()))
    before = _staged(spark)
    got = assign.run_and_publish(inputs, target, config)
    assert Counter(map(tuple, got.collect())) == want
    assert _staged(spark) == before
    assert set(current_manifest(spark, target)["notes"]["gates"].values()) == {0}
    # A gate that does not hold stops the run, and the old version stays.
    strict = assign.Config(overrides=overrides, gates=(*config.gates, Gate("latest", "not_null", ("okta_department",))))
    with pytest.raises(CheckFailed, match="latest: not_null okta_department"):
        assign.run_and_publish(inputs, target, strict)
    assert Counter(map(tuple, read_published(spark, target).collect())) == want
    assert _staged(spark) == before
