"""Typed loading: columns get their declared types, and rows with values that have no such form are told apart.

A value fits if its cast to the declared type loses nothing: text must have the ISO form of the type and
name a real day or number, any other value must come back unchanged when cast again. Some types have no
such cast for any value (a flag as text, a list as a day); those columns fail before a job runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Forms that text of a declared type may have.
_DAY = r"\d{4}-\d{2}-\d{2}"
TEXT_FORMS = {
    T.DateType: f"^{_DAY}$",
    T.TimestampNTZType: rf"^{_DAY}([ T]\d{{2}}:\d{{2}}(:\d{{2}}(\.\d{{1,6}})?)?)?$",
    T.IntegerType: r"^[+-]?\d{1,10}$",
}
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: Declared type -> types whose values may be cast to it.
ACCEPTED = {
    T.StringType: _WHOLE,
    T.DateType: (T.StringType, T.TimestampType, T.TimestampNTZType),
    T.TimestampNTZType: (T.StringType, T.DateType, T.TimestampType),
    T.IntegerType: (T.StringType, *_WHOLE, T.DecimalType, T.FloatType, T.DoubleType),
}
POLICIES = ("fail", "set_aside", "null")
REJECTED = (
    "source string, problems array<struct<column: string, declared: string, found: string, value: string>>, row string"
)


class WrongType(TypeError):
    """A column's type has no lossless cast to the declared one."""


@dataclass(frozen=True)
class Typed:
    """Rows in their declared types, and those that were set aside or lost a value."""

    rows: DataFrame
    rejected: DataFrame


def _whole_decimal(kind: T.DataType) -> bool:
    return isinstance(kind, T.DecimalType) and kind.scale == 0


def _accepts(found: T.DataType, declared: T.DataType) -> bool:
    if isinstance(found, T.NullType) or isinstance(declared, T.StringType) and _whole_decimal(found):
        return True
    return isinstance(found, ACCEPTED.get(type(declared), ()))


def _always_fits(found: T.DataType, declared: T.DataType) -> bool:
    """No value of the type found can be lost."""
    if isinstance(declared, T.StringType) or isinstance(found, T.NullType):
        return True
    if isinstance(declared, T.IntegerType):
        return isinstance(found, (T.ByteType, T.ShortType))
    return isinstance(declared, T.TimestampNTZType) and isinstance(found, T.DateType)


def _cast(value: Column, declared: T.DataType) -> Column:
    return value.try_cast(declared)


def _misfit(value: Column, found: T.DataType, declared: T.DataType) -> Column:
    """Is the value, not being NULL, without a lossless form? Never NULL."""
    there = _cast(value, declared)
    if isinstance(found, T.StringType):
        kept = F.rlike(value, F.lit(TEXT_FORMS[type(declared)])) & there.isNotNull()
    else:
        kept = there.isNotNull() & there.try_cast(found).eqNullSafe(value)
    return value.isNotNull() & ~F.coalesce(kept, F.lit(False))


@dataclass(frozen=True)
class _Change:
    name: str
    found: T.DataType
    declared: T.DataType

    @property
    def value(self) -> Column:
        return F.col(f"`{self.name}`")

    @property
    def misfit(self) -> Column | None:
        return None if _always_fits(self.found, self.declared) else _misfit(self.value, self.found, self.declared)


def _changes(df: DataFrame, declared: T.StructType, source: str) -> list[_Change]:
    """Columns whose type is not the declared one. Names compare whatever their case."""
    wanted = {f.name.lower(): f.dataType for f in declared.fields}
    found = [_Change(f.name, f.dataType, wanted[f.name.lower()]) for f in df.schema.fields if f.name.lower() in wanted]
    # A string type with a length or a collation is text all the same.
    found = [c for c in found if c.found != c.declared and not (isinstance(c.found, T.StringType) and isinstance(c.declared, T.StringType))]
    never = [f"{c.name} is {c.found.simpleString()}, not {c.declared.simpleString()}" for c in found if not _accepts(c.found, c.declared)]
    if never:
        raise WrongType(f"{source}: {'; '.join(never)}")
    return found


def _problems(checked: list[_Change]) -> Column:
    """One entry for each value of the row that does not fit."""
    entries = [
        F.when(
            c.misfit,
            F.struct(
                F.lit(c.name).alias("column"), F.lit(c.declared.simpleString()).alias("declared"),
                F.lit(c.found.simpleString()).alias("found"), c.value.cast("string").alias("value"),
            ),
        )
        for c in checked
    ]
    return F.array_compact(F.array(*entries))


def conform(df: DataFrame, declared: T.StructType, source: str, on_misfit: str = "fail") -> Typed:
    """``df`` with its declared columns in their declared types; other columns stay as they are.

    Columns that have their type already are not touched, so filters on them still reach the scan. What
    happens to values that do not fit: ``"fail"`` ends the job that reads such a value, naming it (columns
    nobody reads are not looked at); ``"set_aside"`` leaves the row out; ``"null"`` makes the value NULL.
    ``rejected`` has, for the last two, each such row once: where it came from, the values that do not
    fit, and the whole row as JSON. It is a plan of its own over the same input, and has no rows, without
    a scan, if no column can hold such a value. NULLs fit every type.
    """
    if on_misfit not in POLICIES:
        raise ValueError(f"on_misfit must be one of {', '.join(POLICIES)}, not {on_misfit!r}")
    changes = _changes(df, declared, source)
    checked = [c for c in changes if c.misfit is not None]
    nothing = df.sparkSession.createDataFrame([], REJECTED)
    if not changes:
        return Typed(df, nothing)
    rows, rejected = df, nothing
    if checked and on_misfit != "fail":
        any_misfit = checked[0].misfit
        for c in checked[1:]:
            any_misfit = any_misfit | c.misfit
        whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
        rejected = df.where(any_misfit).select(F.lit(source).alias("source"), _problems(checked).alias("problems"), whole.alias("row"))
        if on_misfit == "set_aside":
            rows = df.where(~any_misfit)
    typed = {}
    for c in changes:
        there = _cast(c.value, c.declared)
        if c.misfit is not None and on_misfit == "fail":
            what = F.concat(F.lit(f"{source}.{c.name}: not a {c.declared.simpleString()}: "), c.value.cast("string"))
            there = F.when(c.misfit, F.raise_error(what).cast(c.declared)).otherwise(there)
        elif c.misfit is not None:
            there = F.when(~c.misfit, there)
        typed[c.name] = there
    return Typed(rows.select(*[typed.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns]), rejected)
