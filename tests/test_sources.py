import pytest
from conftest import rows

from rostersync.operators.checks import CheckFailed, check_not_null, check_unique, require_empty
from rostersync.plans.example import first_model, second_model
from rostersync.sources.schemas import ASSIGNMENT_COLUMNS, MART_COLUMNS, PREVIOUS_COLUMNS, TABLES
from rostersync.sources.sinks import as_table, as_view
from rostersync.sources.tables import Inputs, MissingColumns, Sources


def _write_all(spark, root, skip=None):
    for name, schema in TABLES.items():
        df = spark.createDataFrame([], schema)
        if skip and name == skip[0]:
            df = df.drop(skip[1])
        df.write.parquet(f"{root}/{name}.parquet")


def test_load_from_a_folder(spark, tmp_path):
    _write_all(spark, tmp_path)
    inputs = Inputs.from_sources(Sources(spark, str(tmp_path)))
    assert inputs.workforce.columns == TABLES["dim_workforce"].names
    assert inputs.lookup.columns == TABLES["looker_user_group"].names


def test_missing_column_fails_early(spark, tmp_path):
    _write_all(spark, tmp_path, skip=("okta_user", "status"))
    with pytest.raises(MissingColumns, match="status"):
        Sources(spark, str(tmp_path)).load("okta_user")
    with pytest.raises(KeyError):
        Sources(spark, str(tmp_path)).load("payroll")


def test_load_from_the_catalog_whatever_the_case(spark):
    for name, schema in TABLES.items():
        df = spark.createDataFrame([], schema)
        as_view(df.toDF(*[c.upper() for c in df.columns]), name)
    df = Sources(spark).load("dim_school")
    assert df.select("esd_school_name").count() == 0
    for name in TABLES:
        spark.catalog.dropTempView(name)


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, s string")
    assert rows(as_view(df, "seen")) == [(1, "a"), (2, None)]
    path = str(tmp_path / "t")
    as_table(df, path=path)
    again = as_table(df.limit(1), path=path)
    assert again.count() == 1 and again.schema == df.schema
    with pytest.raises(ValueError):
        as_table(df)


def test_table_sink_in_the_catalog(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shelf LOCATION '{tmp_path}/shelf'")
    try:
        first = as_table(first_model(spark), name="shelf.first_model")
        assert rows(first) == [(None,), (1,)]
        second = as_table(second_model(spark.table("shelf.first_model")), name="shelf.second_model")
        assert rows(second) == [(1,)]
    finally:
        spark.sql("DROP DATABASE shelf CASCADE")


def test_example_checks(spark):
    first = first_model(spark)
    second = second_model(first)
    assert check_unique(first, "id").count() == 0
    assert rows(check_not_null(first, "id")) == [(None,)]
    for check in (check_unique, check_not_null):
        require_empty(check(second, "id"), "second model")
    with pytest.raises(CheckFailed, match="first model"):
        require_empty(check_not_null(first, "id"), "first model")


def test_unique_reports_each_value_once(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "id int")
    assert rows(check_unique(df, "id")) == [(1, 2)]


def test_column_lists():
    assert len(ASSIGNMENT_COLUMNS) == 23 and len(MART_COLUMNS) == 25
    assert sorted(PREVIOUS_COLUMNS) == sorted(ASSIGNMENT_COLUMNS)
