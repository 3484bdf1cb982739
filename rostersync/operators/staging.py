"""Writing a shared relation down once, and broadcasting only what is known to be small."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostersync.operators import gates as gate_checks
from rostersync.operators.files import Files

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024


def staging_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (``spark.checkpoint.dir``).

    Only a local session may fall back to a folder of its own: on a cluster a machine-local path
    would be lost with the machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="rostersync-")
    context.setCheckpointDir(own)
    return own


def _unseen(spark: SparkSession, marker: str) -> int:
    """How many tasks do not see a local file."""

    def look(batches: Iterator) -> Iterator:
        for batch in batches:
            yield batch.assign(id=int(not os.path.exists(marker)))

    tasks = 2 * spark.sparkContext.defaultParallelism
    seen = spark.range(0, tasks, 1, tasks).mapInPandas(look, "id long")
    return seen.agg(F.sum("id")).first()[0]


def check_shared(spark: SparkSession, folder: str) -> None:
    """Refuse a machine-local folder: what one executor writes there, the others would not find.

    A ``file:`` path may still be a mount that all machines share, so a file put there by the driver
    is looked for from tasks. Other schemes are shared by nature.
    """
    files = Files(spark)
    if files.scheme(folder) != "file":
        return
    marker = f"{folder}/shared-{uuid.uuid4().hex}"
    files.write_new(marker, "")
    try:
        unseen = _unseen(spark, files.local_name(marker))
    finally:
        files.drop(marker)
    if unseen:
        raise RuntimeError(f"{folder} is not shared: {unseen} tasks do not see what the driver wrote there")


_checked: set[tuple[str, str]] = set()
_scope: ContextVar[RunFolder | None] = ContextVar("run_folder", default=None)


@dataclass
class RunFolder:
    """The folder of one run, and what was written there."""

    path: str
    written: list[dict[str, object]] = field(default_factory=list)


@contextmanager
def run_folder(spark: SparkSession, name: str = "run") -> Iterator[RunFolder]:
    """Within the block, staged relations go to a folder of their own, which is dropped at the end.

    Also after an error. Relations staged within the block cannot be read after it; what is to stay must
    be stored elsewhere (``sinks.publish``) before.
    """
    folder = RunFolder(f"{_application_dir(spark)}/{name}-{uuid.uuid4().hex}")
    token = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(token)
        Files(spark).drop(folder.path)


def _application_dir(spark: SparkSession) -> str:
    folder, application = staging_dir(spark), spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local") and (application, folder) not in _checked:
        check_shared(spark, folder)
        _checked.add((application, folder))
    return f"{folder}/{application}"


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and return the written relation.

    Cuts lineage, survives the loss of executors, lets later readers prune columns, and gives the
    optimizer the true size. The files stay until the folder is cleaned, as checkpoints do; within a
    ``run_folder`` block they go with the run. Gates in force for ``label`` are checked (``gates.gated``).
    """
    spark = df.sparkSession
    scope = _scope.get()
    path = f"{scope.path if scope else _application_dir(spark)}/{label}-{uuid.uuid4().hex}"
    watched, observation, gates = gate_checks.observed(df, label)
    watched.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    outcomes = gate_checks.judge(written, observation, gates) if gates else []
    if scope:
        scope.written.append({"label": label, "path": path, "gates": {o.gate.name: o.violations for o in outcomes}})
    return written


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Does ``df`` hold at most ``rows`` rows and ``size`` bytes of text? Reads ``rows + 1`` rows."""
    text = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns]
    width = sum(text[1:], text[0]) if text else F.lit(0)
    found = (
        df.select(width.cast("long").alias("w"))
        .limit(rows + 1)
        .agg(F.count("*").alias("n"), F.coalesce(F.sum("w"), F.lit(0)).alias("w"))
        .first()
    )
    return found["n"] <= rows and found["w"] <= size


def broadcast_if_small(
    df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES
) -> DataFrame:
    """Hint a broadcast after checking the size; otherwise leave the join to the optimizer."""
    return F.broadcast(df) if is_small(df, rows, size) else df
