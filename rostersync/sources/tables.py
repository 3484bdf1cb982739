"""Loading the four inputs by name."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from rostersync.sources.contracts import Typed, conform
from rostersync.sources.schemas import TABLES


class MissingColumns(ValueError):
    """A declared column is not in the table."""


def check_columns(df: DataFrame, name: str) -> DataFrame:
    """Fail at plan time, not with silent NULLs, when a declared column is absent."""
    present = {c.lower() for c in df.columns}
    missing = [f.name for f in TABLES[name].fields if f.name.lower() not in present]
    if missing:
        raise MissingColumns(f"{name}: missing {', '.join(missing)}")
    return df


@dataclass(frozen=True)
class Sources:
    """Where the inputs live: a Parquet folder (``root``) or a catalog schema (``schema``).

    ``on_misfit`` says what becomes of values that have no form in the declared type (``contracts.conform``).
    """

    spark: SparkSession
    root: str | None = None
    schema: str | None = None
    on_misfit: str = "fail"

    def load(self, name: str) -> DataFrame:
        """All columns of one input, the declared ones in their types; readers prune what they use."""
        return self.typed(name).rows

    def rejected(self) -> DataFrame:
        """Rows of all inputs with values that do not fit: source, problems, row."""
        found = [self.typed(name).rejected for name in TABLES]
        return reduce(DataFrame.unionByName, found)

    def typed(self, name: str) -> Typed:
        """One input and what was rejected of it."""
        if name not in TABLES:
            raise KeyError(f"unknown source {name!r}; known: {', '.join(TABLES)}")
        if self.root is not None:
            df = self.spark.read.parquet(f"{self.root.rstrip('/')}/{name}.parquet")
        else:
            df = self.spark.table(f"{self.schema}.{name}" if self.schema else name)
        return conform(check_columns(df, name), TABLES[name], name, self.on_misfit)


@dataclass(frozen=True)
class Inputs:
    """The four input relations of the assignment run."""

    workforce: DataFrame
    accounts: DataFrame
    schools: DataFrame
    lookup: DataFrame

    @classmethod
    def from_sources(cls, sources: Sources) -> Inputs:
        return cls(
            workforce=sources.load("dim_workforce"),
            accounts=sources.load("okta_user"),
            schools=sources.load("dim_school"),
            lookup=sources.load("looker_user_group"),
        )
