"""The two starter relations: a literal one with a NULL id, and the rows of it with id 1."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostersync.operators.sets import union_all


def first_model(spark: SparkSession) -> DataFrame:
    """Ids 1 and NULL."""
    return union_all(
        spark.createDataFrame([(1,)], "id int"), spark.createDataFrame([(None,)], "id int")
    )


def second_model(first: DataFrame) -> DataFrame:
    """Rows of the first relation with id 1."""
    return first.where(F.col("id") == 1)
