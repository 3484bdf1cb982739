"""View, table and published sinks."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from rostersync.operators.files import Files


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register the plan under a name; each read runs it again. Returns the named relation."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def as_table(
    df: DataFrame, name: str | None = None, path: str | None = None, mode: str = "overwrite"
) -> DataFrame:
    """Store the rows, as a catalog table or as a Parquet folder, and return the stored relation."""
    if (name is None) == (path is None):
        raise ValueError("give exactly one of name, path")
    if path is not None:
        df.write.mode(mode).parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    df.write.mode(mode).saveAsTable(name)
    return df.sparkSession.table(name)


def _manifests(files: Files, target: str) -> list[str]:
    return [n for n in files.names(f"{target}/manifests") if n.endswith(".json")]


def current_manifest(spark: SparkSession, target: str) -> dict:
    """What the last publication wrote down: version, path, schema and the notes given with it."""
    files = Files(spark)
    found = _manifests(files, target)
    if not found:
        raise FileNotFoundError(f"nothing is published at {target}")
    return json.loads(files.read(f"{target}/manifests/{found[-1]}"))


def publish(df: DataFrame, target: str, notes: dict | None = None, keep: int = 1) -> DataFrame:
    """Store the rows as a new version of ``target`` and make it the current one; returns the stored relation.

    The rows are written to a folder of their own first. A manifest, a small file that appears whole or
    not at all, then names it, so readers see the old version or the new one, and a run that fails before
    leaves the old one current. Of two publications at once the later one fails. ``keep`` versions stay,
    older ones are dropped with whatever unfinished runs left behind; readers of those should be done.
    """
    target = target.rstrip("/")
    spark = df.sparkSession
    files = Files(spark)
    before = _manifests(files, target)
    number = int(before[-1].split(".")[0]) + 1 if before else 1
    version = f"{number:010d}-{uuid.uuid4().hex}"
    path = f"{target}/versions/{version}"
    df.write.parquet(path)
    manifest = {"version": version, "path": path, "schema": json.loads(df.schema.json()), "notes": notes or {}}
    try:
        files.write_new(f"{target}/manifests/{number:010d}.json", json.dumps(manifest))
    except FileExistsError:
        files.drop(path)
        raise
    kept = _manifests(files, target)[-keep:]
    names = {json.loads(files.read(f"{target}/manifests/{m}"))["version"] for m in kept}
    for manifest_name in _manifests(files, target)[:-keep]:
        files.drop(f"{target}/manifests/{manifest_name}")
    for old in files.names(f"{target}/versions"):
        # A later number belongs to a publication that may still be under way.
        if old not in names and int(old.split("-")[0]) <= number:
            files.drop(f"{target}/versions/{old}")
    return spark.read.schema(df.schema).parquet(path)


def read_published(spark: SparkSession, target: str) -> DataFrame:
    """The current version of what was published at ``target``."""
    manifest = current_manifest(spark, target.rstrip("/"))
    return spark.read.schema(StructType.fromJson(manifest["schema"])).parquet(manifest["path"])
