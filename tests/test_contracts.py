"""Declared types: every declared column with a wrong type, and each policy for values that do not fit."""

import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostersync.sources.contracts import WrongType, conform
from rostersync.sources.schemas import TABLES
from rostersync.sources.tables import Sources

COLUMNS = [(table, field) for table, schema in TABLES.items() for field in schema.fields]
IDS = [f"{table}.{field.name}" for table, field in COLUMNS]


def _empty(spark, table, column, kind):
    fields = [T.StructField(f.name, kind if f.name == column else f.dataType) for f in TABLES[table].fields]
    return spark.createDataFrame([], T.StructType(fields))


@pytest.mark.parametrize("table, field", COLUMNS, ids=IDS)
def test_a_type_without_cast_fails_before_any_job(spark, table, field):
    for kind in (T.BooleanType(), T.ArrayType(T.StringType()), T.BinaryType()):
        with pytest.raises(WrongType, match=field.name):
            conform(_empty(spark, table, field.name, kind), TABLES[table], table)


@pytest.mark.parametrize("table, field", COLUMNS, ids=IDS)
def test_an_accepted_type_becomes_the_declared_one(spark, table, field):
    other = T.LongType() if isinstance(field.dataType, T.StringType) else T.StringType()
    df = _empty(spark, table, field.name, other)
    for policy in ("fail", "set_aside", "null"):
        assert conform(df, TABLES[table], table, policy).rows.schema[field.name].dataType == field.dataType


@pytest.mark.parametrize("table, field", [c for c in COLUMNS if not isinstance(c[1].dataType, T.StringType)], ids=str)
def test_wrong_values_of_each_typed_column(spark, table, field):
    good = {"date": "2020-02-29", "timestamp_ntz": "2020-02-29 10:00:00", "int": "22"}[field.dataType.simpleString()]
    values = [good, None, "n/a", "", "2020-02-30", "22.5"]
    fields = [T.StructField(f.name, T.StringType() if f.name == field.name else f.dataType) for f in TABLES[table].fields]
    at = TABLES[table].names.index(field.name)
    data = [tuple(v if i == at else None for i in range(len(fields))) for v in values]
    df = spark.createDataFrame(data, T.StructType(fields))
    typed = conform(df, TABLES[table], table, "set_aside")
    kept = [r[0] for r in typed.rows.select(F.col(field.name).cast("string")).collect()]
    assert sorted(kept, key=str) == sorted([good, None], key=str)
    bad = [r.asDict(recursive=True) for r in typed.rejected.collect()]
    assert sorted(b["problems"][0]["value"] for b in bad) == sorted(values[2:])
    assert {b["problems"][0]["column"] for b in bad} == {field.name} and {b["source"] for b in bad} == {table}
    assert {json.loads(b["row"])[field.name] for b in bad} == set(values[2:])
    nulled = conform(df, TABLES[table], table, "null")
    assert nulled.rows.count() == len(values) and nulled.rejected.count() == 4
    assert nulled.rows.where(F.col(field.name).isNotNull()).count() == 1
    with pytest.raises(PySparkException, match=f"{table}.{field.name}"):
        conform(df, TABLES[table], table).rows.select(field.name).collect()
    # Columns nobody reads are not looked at.
    assert conform(df, TABLES[table], table).rows.count() == len(values)


DECLARED = T.StructType().add("s", "string").add("d", "date").add("t", "timestamp_ntz").add("i", "integer")


def test_lossless_casts_of_other_types(spark):
    noon, midnight = dt.datetime(2020, 1, 1, 12), dt.datetime(2020, 1, 1)
    data = [(7, midnight, midnight.date(), 5.0), (8, noon, None, 5.5), (None, None, None, 3e10), (9, midnight, None, None)]
    df = spark.createDataFrame(data, "s bigint, d timestamp_ntz, t date, i double")
    typed = conform(df, DECLARED, "x", "set_aside")
    assert typed.rows.dtypes == [("s", "string"), ("d", "date"), ("t", "timestamp_ntz"), ("i", "int")]
    assert rows(typed.rows) == [("7", midnight.date(), midnight, 5), ("9", midnight.date(), None, None)]
    problems = {tuple(p.column for p in r.problems) for r in typed.rejected.collect()}
    assert problems == {("d", "i"), ("i",)}


def test_whole_decimals_are_text_others_are_not(spark):
    whole = spark.sql("SELECT CAST(12 AS DECIMAL(20, 0)) AS s, DATE '2020-01-01' AS d, NULL AS t, 1 AS i")
    assert rows(conform(whole, DECLARED, "x").rows.select("s", "t")) == [("12", None)]
    with pytest.raises(WrongType, match="s is decimal"):
        conform(whole.withColumn("s", F.lit("1.5").cast("decimal(5, 2)")), DECLARED, "x")


def test_right_types_are_left_alone(spark):
    df = spark.createDataFrame([("a", None, None, 1)], DECLARED)
    typed = conform(df.withColumn("more", F.lit(1)), DECLARED, "x", "set_aside")
    assert typed.rows.columns == ["s", "d", "t", "i", "more"] and typed.rejected.isEmpty()
    assert conform(df, DECLARED, "x").rows is df


def test_names_in_any_case_and_unknown_policy(spark):
    df = spark.createDataFrame([(1, "2020-01-01")], "S int, D string")
    assert rows(conform(df, DECLARED, "x").rows) == [("1", dt.date(2020, 1, 1))]
    with pytest.raises(ValueError, match="on_misfit"):
        conform(df, DECLARED, "x", "ignore")


def test_filters_still_reach_the_scan_of_untouched_columns(spark, tmp_path):
    spark.createDataFrame([("ACTIVE", 1)], "status string, employee_number bigint").write.parquet(f"{tmp_path}/a")
    declared = T.StructType().add("status", "string").add("employee_number", "string")
    rows_ = conform(spark.read.parquet(f"{tmp_path}/a"), declared, "a").rows.where("status = 'ACTIVE'")
    assert "EqualTo(status,ACTIVE)" in rows_._jdf.queryExecution().toString()


def test_sources_load_typed_tables(spark, tmp_path):
    for name, schema in TABLES.items():
        df = spark.createDataFrame([], schema)
        if name == "dim_workforce":
            df = spark.createDataFrame([(1, "2020-01-01"), (2, "soon")], "worker_id bigint, hire_date string")
            df = df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    sources = Sources(spark, str(tmp_path), on_misfit="set_aside")
    assert sources.load("dim_workforce").schema == TABLES["dim_workforce"]
    assert rows(sources.load("dim_workforce").select("worker_id", "hire_date")) == [("1", dt.date(2020, 1, 1))]
    assert [r.problems[0].value for r in sources.rejected().collect()] == ["soon"]
    with pytest.raises(PySparkException, match="dim_workforce.hire_date: not a date: soon"):
        Sources(spark, str(tmp_path)).load("dim_workforce").select("hire_date").collect()
