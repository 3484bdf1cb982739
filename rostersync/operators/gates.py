"""Checks that stop a run: measured while relations are written, not by reading them again.

A gate names a staged relation by its label and what must hold for its rows. Counts of rows that break a
gate are gathered by the very job that writes the relation. Only uniqueness cannot be counted row by row;
it groups the written relation's key columns, which is a read of those columns alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rostersync.operators.checks import CheckFailed


@dataclass(frozen=True)
class Gate:
    """What must hold for the rows of the relation called ``relation``.

    ``kind`` and ``columns``: ``not_null`` (each column), ``unique`` (the columns together; rows with a
    NULL among them are not compared), ``accepted`` (one column, NULL or one of ``values``), ``rows`` (at
    least ``least`` rows), ``holds`` (``test`` is not false; NULL counts as unknown and passes).
    """

    relation: str
    kind: str
    columns: tuple[str, ...] = ()
    values: tuple[object, ...] = ()
    least: int = 0
    test: str = ""

    def __post_init__(self) -> None:
        if self.kind not in ("not_null", "unique", "accepted", "rows", "holds"):
            raise ValueError(f"unknown gate {self.kind!r}")

    @property
    def name(self) -> str:
        detail = self.test or ", ".join(self.columns) or f">= {self.least}"
        return f"{self.relation}: {self.kind} {detail}"

    def broken(self) -> Column | None:
        """Does a row break the gate? None for gates on more than one row."""
        if self.kind == "not_null":
            test = F.lit(False)
            for c in self.columns:
                test = test | F.col(c).isNull()
            return test
        if self.kind == "accepted":
            value = F.col(self.columns[0])
            return value.isNotNull() & ~value.isin(*self.values)
        if self.kind == "holds":
            return ~F.expr(self.test)
        return None


@dataclass(frozen=True)
class Outcome:
    """How many rows broke a gate (for ``unique``: how many keys repeat; for ``rows``: how many are lacking)."""

    gate: Gate
    violations: int


@dataclass
class Watch:
    """Gates in force, and what came of them."""

    gates: tuple[Gate, ...]
    stop: bool
    outcomes: list[Outcome]

    def on(self, label: str) -> list[Gate]:
        return [g for g in self.gates if g.relation == label]


_watch: ContextVar[Watch | None] = ContextVar("watch", default=None)


@contextmanager
def gated(gates: Iterable[Gate], stop: bool = True) -> Iterator[Watch]:
    """Within the block, staged relations are held against ``gates``.

    The first broken one raises ``CheckFailed`` as soon as its relation is written, unless ``stop`` is
    off; the outcomes are gathered either way. An inner block's gates come on top of an outer one's.
    """
    outer = _watch.get()
    watch = Watch((*(outer.gates if outer else ()), *gates), stop, [])
    token = _watch.set(watch)
    try:
        yield watch
    finally:
        _watch.reset(token)
        if outer:
            outer.outcomes += watch.outcomes


def observed(df: DataFrame, label: str) -> tuple[DataFrame, Observation | None, list[Gate]]:
    """``df`` with the counts its gates need gathered on the way."""
    watch = _watch.get()
    gates = watch.on(label) if watch else []
    counts = [F.count(F.lit(1)).alias("rows")]
    counts += [F.count_if(F.coalesce(b, F.lit(False))).alias(f"g{i}") for i, g in enumerate(gates) if (b := g.broken()) is not None]
    if all(g.kind == "unique" for g in gates):
        return df, None, gates
    observation = Observation()
    return df.observe(observation, *counts), observation, gates


def _repeated(written: DataFrame, columns: Sequence[str]) -> int:
    return written.dropna(subset=list(columns)).groupBy(*columns).count().where("count > 1").count()


def judge(written: DataFrame, observation: Observation | None, gates: list[Gate]) -> list[Outcome]:
    """Outcomes of the gates of a relation just written; raises at the first broken one if the block stops."""
    watch = _watch.get()
    counts = observation.get if observation else {}
    found = []
    for i, gate in enumerate(gates):
        if gate.kind == "unique":
            violations = _repeated(written, gate.columns)
        elif gate.kind == "rows":
            violations = max(0, gate.least - counts.get("rows", 0))
        else:
            violations = counts.get(f"g{i}", 0)
        found.append(Outcome(gate, violations))
    watch.outcomes += found
    broken = [f"{o.gate.name} ({o.violations})" for o in found if o.violations]
    if broken and watch.stop:
        raise CheckFailed("; ".join(broken))
    return found
