"""Ordered text rules: the first one that holds names the group."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostersync.operators.staging import is_small, materialise

OPS = ("is", "like", "unlike")


@dataclass(frozen=True)
class Condition:
    """One column against several values. ``is`` and ``like`` want any of them, ``unlike`` none.

    ``is`` compares exactly; ``like`` and ``unlike`` take LIKE patterns and ignore case. A NULL
    column fails every test, ``unlike`` included.
    """

    column: str
    op: str
    values: tuple[str, ...]

    def __post_init__(self) -> None:
        if self.op not in OPS:
            raise ValueError(f"unknown test {self.op!r}")


@dataclass(frozen=True)
class Rule:
    """``label`` for rows that pass all tests; with ``suffix``, `` (<that column>)`` is appended."""

    label: str
    tests: tuple[Condition, ...]
    suffix: str | None = None


def is_(column: str, *values: str) -> Condition:
    return Condition(column, "is", values)


def like(column: str, *patterns: str) -> Condition:
    return Condition(column, "like", patterns)


def unlike(column: str, *patterns: str) -> Condition:
    return Condition(column, "unlike", patterns)


def _text(test: Condition) -> str:
    """The helper column a test reads: the column, lowered for patterns, with '' in place of NULL."""
    return f"__exact_{test.column}" if test.op == "is" else f"__lower_{test.column}"


def _holds(test: Condition) -> Column:
    """Never NULL, which keeps the generated code short."""
    text = F.col(_text(test))
    if test.op == "is":
        out = text.isin(*test.values)
    else:
        out = text.like(test.values[0].lower())
        for value in test.values[1:]:
            out = out | text.like(value.lower())
    if test.op == "unlike":
        out = ~out
    if test.op == "unlike" or not all(v.strip("%") for v in test.values):
        out = out & F.col(test.column).isNotNull()
    return out


def _label(rules: Sequence[Rule], number: str) -> Column:
    """The label of a rule number, from a constant list; some labels take a column in brackets."""
    at = F.col(number) + 1
    label = F.element_at(F.array(*[F.lit(r.label) for r in rules]), at)
    suffixes = sorted({r.suffix for r in rules if r.suffix is not None})
    out = None
    for suffix in suffixes:
        has = F.element_at(F.array(*[F.lit(r.suffix == suffix) for r in rules]), at)
        full = F.concat(label, F.lit(" ("), F.col(suffix), F.lit(")"))
        out = F.when(has, full) if out is None else out.when(has, full)
    return label if out is None else out.otherwise(label)


def classify(
    df: DataFrame,
    rules: Sequence[Rule],
    default: str | None = None,
    name: str = "looker_user_group",
) -> DataFrame:
    """Add ``name``: the label of the first rule that holds, else column ``default``, else NULL.

    One CASE expression gives the number of the rule; no shuffle and no Python per row. Texts are
    lowered once and a test that several rules share is computed once. Besides saving time, that
    keeps the generated method of the longer set below the size (8,000 bytes) from which the JVM no
    longer compiles it.
    """
    if not rules:
        raise ValueError("no rules")
    tests = [t for r in rules for t in r.tests]
    texts = {}
    for test in tests:
        whole = F.col(test.column)
        texts[_text(test)] = F.coalesce(whole if test.op == "is" else F.lower(whole), F.lit(""))
    shared = {t: f"__test_{i}" for i, t in enumerate(dict.fromkeys(tests)) if tests.count(t) > 1}
    rows = df.withColumns(texts)
    if shared:
        rows = rows.withColumns({c: _holds(t) for t, c in shared.items()})

    def cost(test: Condition) -> int:
        return 0 if test in shared else 1 if test.op == "is" else 2

    chain = None
    for number, rule in enumerate(rules):
        holds = [F.col(shared[t]) if t in shared else _holds(t) for t in sorted(rule.tests, key=cost)]
        test = holds[0]
        for more in holds[1:]:
            test = test & more
        chain = F.when(test, number) if chain is None else chain.when(test, number)
    otherwise = F.lit(None).cast("string") if default is None else F.col(default)
    group = F.when(F.col("__rule").isNull(), otherwise).otherwise(_label(rules, "__rule"))
    # The one-element explode is a fence: a filter on the group, which the optimizer would otherwise
    # push below the rules as a second copy of them all, stays above it.
    return (
        rows.withColumn("__rule", F.explode(F.array(chain)))
        .withColumn(name, group)
        .drop(*texts, *shared.values(), "__rule")
    )


def rule_inputs(rules: Sequence[Rule], default: str | None = None) -> list[str]:
    """The columns a rule set reads: tested ones, those put in brackets, the default."""
    tested = [t.column for r in rules for t in r.tests]
    shown = [r.suffix for r in rules if r.suffix is not None]
    return list(dict.fromkeys([*tested, *shown, *([default] if default else [])]))


def classify_distinct(
    df: DataFrame, rules: Sequence[Rule], default: str | None = None, name: str = "looker_user_group"
) -> DataFrame:
    """The same as ``classify``, each distinct tuple of the rules' inputs being classified once.

    Titles, departments and schools come in far fewer combinations than people, so the tuples are taken
    down, classified, and broadcast back, NULLs matching NULLs. If they are too many to broadcast, every
    row goes through the rules. Reads ``df`` twice, the first time only the inputs; worth it for a stored
    or cheap ``df`` with many rows.
    """
    columns = rule_inputs(rules, default)
    inputs = materialise(df.select(*columns).distinct(), "rule-inputs")
    if not is_small(inputs):
        return classify(df, rules, default, name)
    answers = classify(inputs, rules, default, name)
    keys = {c: f"__in_{i}" for i, c in enumerate(columns)}
    table = F.broadcast(answers.select(*[F.col(c).alias(k) for c, k in keys.items()], F.col(name).alias("__answer")))
    test = F.lit(True)
    for c, k in keys.items():
        test = test & F.col(c).eqNullSafe(F.col(k))
    # A group that was there before gives way, as it does in ``classify``.
    kept = [F.col("__answer").alias(name) if c == name else F.col(c) for c in df.columns]
    added = [] if name in df.columns else [F.col("__answer").alias(name)]
    return df.join(table, test, "left").select(*kept, *added)


def repeated_rules(rules: Sequence[Rule]) -> list[int]:
    """Positions of rules that can never fire because an earlier one has the same tests."""
    seen: set[frozenset[tuple[str, str, frozenset[str]]]] = set()
    out = []
    for i, rule in enumerate(rules):
        key = frozenset(
            (t.column, t.op, frozenset(v if t.op == "is" else v.lower() for v in t.values))
            for t in rule.tests
        )
        if key in seen:
            out.append(i)
        seen.add(key)
    return out
