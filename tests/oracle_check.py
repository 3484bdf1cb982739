"""Run a registered query in both engines and compare rows as multisets."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _bag(columns: list[str], rows: list) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences found; empty when the engines agree."""
    problems = []
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    ours = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if sorted(ours) != sorted(kinds):
        return [f"columns: {sorted(ours)} / {sorted(kinds)}"]
    same = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}
    for name, kind in ours.items():
        if same.get(kind) != kinds[name]:
            problems.append(f"type of {name}: {kind} / {kinds[name]}")
    names = list(kinds)
    spark_rows = _bag(df.columns, [tuple(r) for r in df.collect()])
    duck_rows = _bag(names, con.execute(sql).fetchall())
    if spark_rows != duck_rows:
        extra, missing = spark_rows - duck_rows, duck_rows - spark_rows
        problems.append(
            f"rows: {sum(spark_rows.values())} / {sum(duck_rows.values())}; "
            f"only Spark {sum(extra.values())} {list(extra)[:2]}; only SQL {sum(missing.values())} {list(missing)[:2]}"
        )
    return problems
