"""Near-duplicate vectors by lattice hashing: random projections decoded to points of the E8 lattice.

In each of several tables a vector is projected to blocks of eight numbers, each block is decoded to its
nearest E8 point, and the points together name a cell. A vector is stored in its own cell and looks into
the likeliest neighbouring ones too. Vectors that meet are compared by cosine, so no false link remains.
Equal vectors are one node from the start; what is compared grows with the number of different ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostersync.llm.common import col
from rostersync.llm.components import components
from rostersync.operators.staging import materialise

#: Width of the projections, in units of the lattice, and the cells a vector looks into per table.
SCALE, PROBES, NEIGHBOURS = 0.45, 12, 11
#: Chance to miss a pair at the threshold, drawn pairs from which it is worked out, and the most tables.
MISS, DRAWN, MOST_TABLES = 1e-5, 10_000, 256
#: Bits of a cell's name that one block adds, about.
BLOCK_BITS = 8


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in combinations(range(8), 2):
        for s in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s
            out.append(v)
    out += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


ROOTS = _roots()


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: where it is odd, the worst coordinate goes the other way."""
    near = np.rint(x)
    rows = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    off = x[rows] - near[rows]
    worst = np.abs(off).argmax(axis=1)
    near[rows, worst] += np.where(off[np.arange(len(rows)), worst] >= 0, 1.0, -1.0)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """(n, 8) -> the nearest points of E8: even integer points, or those moved by a half."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, half)


def _mix(points: np.ndarray, table: int) -> np.ndarray:
    """(..., k) points -> a 64-bit name; halves become whole numbers first."""
    whole = (2 * points).astype(np.int64).view(np.uint64)
    name = np.full(points.shape[:-1], table + 1, np.uint64)
    for k in range(points.shape[-1]):
        name = (name ^ whole[..., k]) * np.uint64(0x9E3779B97F4A7C15)
        name ^= name >> np.uint64(29)
    return name.view(np.int64)


def cells(unit: np.ndarray, table: int, blocks: int, probes: int = PROBES, seed: int = 8) -> np.ndarray:
    """(n, d) unit vectors -> (n, probes) cell names, the own cell first, then the nearest ones."""
    d = unit.shape[1]
    turn = np.random.default_rng([seed, table, d]).standard_normal((d, 8 * blocks)) * SCALE
    return _probed(unit @ turn, table, blocks, probes)


def _probed(y: np.ndarray, table: int, blocks: int, probes: int) -> np.ndarray:
    """(n, 8 blocks) projections -> (n, probes) cell names."""
    n = len(y)
    points, costs = [], []
    for b in range(blocks):
        z = y[:, 8 * b : 8 * b + 8]
        own = nearest_e8(z)
        gain = (z - own) @ ROOTS.T
        top = np.argsort(-gain, axis=1, kind="stable")[:, :NEIGHBOURS]
        points.append(np.concatenate([own[:, None], own[:, None] + ROOTS[top]], axis=1))
        # By how much a neighbour is farther away than the own point.
        costs.append(np.concatenate([np.zeros((n, 1)), 2 - 2 * np.take_along_axis(gain, top, axis=1)], axis=1))
    choices = np.array(_choices(blocks))
    total = np.stack([sum(costs[b][:, c[b]] for b in range(blocks)) for c in choices.tolist()], axis=1)
    best = np.argsort(total, axis=1, kind="stable")[:, :probes]
    chosen = choices[best]  # (n, probes, blocks)
    rows = np.arange(n)[:, None]
    return _mix(np.concatenate([points[b][rows, chosen[:, :, b]] for b in range(blocks)], axis=2), table)


def _choices(blocks: int) -> list[list[int]]:
    """Which point each block takes, its own (0) or a neighbour, in order. At most two blocks leave their
    own point: more is rarely among the nearest."""
    out = [[0] * blocks]
    for left in (1, 2):
        for at in combinations(range(blocks), left):
            for taken in product(range(1, NEIGHBOURS + 1), repeat=left):
                choice = [0] * blocks
                for b, c in zip(at, taken, strict=True):
                    choice[b] = c
                out.append(choice)
    return sorted(out)


@cache
def meeting(least: float, blocks: int) -> float:
    """A lower bound of the share of pairs at a cosine of ``least`` that meet in one table.

    Random projections of two unit vectors are normal numbers with the cosine as their correlation,
    whatever their length, so pairs of such numbers are drawn and hashed as vectors are.
    """
    make = np.random.default_rng([blocks, 17])
    x = make.standard_normal((DRAWN, 8 * blocks))
    y = least * x + math.sqrt(max(0.0, 1 - least * least)) * make.standard_normal(x.shape)
    met = 0
    for start in range(0, DRAWN, 1000):
        a, b = (_probed(v[start : start + 1000] * SCALE, 0, blocks, PROBES) for v in (x, y))
        met += int(((a == b[:, :1]).any(axis=1) | (b == a[:, :1]).any(axis=1)).sum())
    share = met / DRAWN
    return share - 3 * math.sqrt(share * (1 - share) / DRAWN)


def plan(vectors: int, least: float) -> tuple[int, int]:
    """(blocks, tables): cells about as many as vectors, whatever their number, and tables for the wanted recall."""
    blocks = max(2, math.ceil(math.log2(max(vectors, 2)) / BLOCK_BITS))
    share = meeting(least, blocks)
    tables = math.ceil(math.log(MISS) / math.log(1 - share)) if 0 < share < 1 else MOST_TABLES + 1 if share <= 0 else 1
    if tables > MOST_TABLES:
        raise ValueError(f"a cosine of {least} is too far for {vectors} vectors: {tables} tables would be needed")
    return blocks, tables


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _cells_of(blocks: int, tables: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                nodes, sizes = part.column(0).to_numpy(), part.column(2).to_numpy()
                for d in np.unique(sizes):
                    rows = np.flatnonzero(sizes == d)
                    x = _matrix(part.column(3).take(pa.array(rows)))
                    # The largest component first, so that no square under- or overflows.
                    x /= np.abs(x).max(axis=1, keepdims=True)
                    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
                    found = np.concatenate([cells(x, t, blocks) for t in range(tables)], axis=1)
                    n, probes = len(rows), found.shape[1]
                    own = np.tile(np.arange(probes) % PROBES == 0, n)
                    again = np.repeat(rows, probes)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(nodes[again]), part.column(1).take(pa.array(again)), pa.array(sizes[again]), pa.array(found.ravel()), pa.array(own)],
                        names=["node", "label", "dims", "cell", "own"],
                    )

    return run


def _verify(least: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                sizes = part.column(2).to_numpy()
                for d in np.unique(sizes):
                    rows = pa.array(np.flatnonzero(sizes == d))
                    x, y = (_matrix(part.column(k).take(rows)) for k in (3, 4))
                    x /= np.abs(x).max(axis=1, keepdims=True)
                    y /= np.abs(y).max(axis=1, keepdims=True)
                    cosine = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
                    good = rows.filter(pa.array(cosine >= least))
                    yield pa.RecordBatch.from_arrays([part.column(0).take(good), part.column(1).take(good)], names=["a", "b"])

    return run


def near_vectors(
    vectors: DataFrame,
    least: float = 0.98,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Vectors of equal, non-null labels and equal length are linked when their cosine, in double
    precision, is at least ``least``. A vector that is null, empty or zero, or that holds null or
    non-finite components, or has no label, links with nothing: 0 links, a component of its own. Rows
    with equal vectors and labels are linked with each other, repeated ids too. ``component_id`` is the
    smallest id reachable by links (null if all are null); ``kept`` is vec_id = component_id (false for
    a null id that others replace). An empty table gives no rows. Other columns are not looked at.
    Candidates come from hashing: a pair at the threshold is missed with a chance of at most about ``MISS``,
    whatever ``least`` and the number of vectors; thresholds so low that this takes more than
    ``MOST_TABLES`` tables are refused.
    """
    body = col(embedding)
    finite = F.forall(body, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(col(label).isNotNull() & body.isNotNull() & finite & F.exists(body, lambda x: x != 0), F.lit(False))
    rows = vectors.select(
        col(vec_id).cast("long").alias("vec_id"),
        F.when(usable, F.xxhash64(col(label), body)).alias("node"),
        F.when(usable, F.xxhash64(col(label))).alias("label"),
        body.cast("array<double>").alias("embedding"),
    )
    # Equal vectors, a third of the table maybe, become one node before anything else is shuffled.
    nodes = (
        rows.filter("node IS NOT NULL")
        .groupBy("node")
        .agg(F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    )
    nodes = materialise(nodes, "vectors")
    blocks, tables = plan(nodes.count(), least)
    read = nodes.select("node", "label", F.size("embedding").alias("dims"), "embedding")
    hashed = read.mapInArrow(_cells_of(blocks, tables), "node long, label long, dims int, cell long, own boolean")
    hashed = materialise(hashed, "cells")
    key = ["label", "dims", "cell"]
    stored = hashed.filter("own").select(*key, F.col("node").alias("b"))
    asked = hashed.select(*key, F.col("node").alias("a"), "own")
    # Two in one cell meet once; else the one that looks in finds the other.
    met = stored.join(asked, key).filter("a <> b AND (NOT own OR a < b)")
    pairs = met.select("dims", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left = nodes.select(F.col("node").alias("a"), F.col("embedding").alias("x"))
    right = nodes.select(F.col("node").alias("b"), F.col("embedding").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "dims", "x", "y")
    links = materialise(both.mapInArrow(_verify(least), "a long, b long"), "vector-links")
    degree = (
        links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .join(nodes.select(F.col("node").alias("b"), "copies"), "b")
        .groupBy(F.col("a").alias("node"))
        .agg(F.sum("copies").alias("others"))
    )
    root = components(links)
    least_id = root.join(nodes.select("node", "first"), "node").groupBy("root").agg(F.min("first").alias("least_id"))
    of = (
        nodes.select("node", "copies", "first")
        .join(degree, "node", "left")
        .join(root.join(least_id, "root").select("node", "least_id"), "node", "left")
        .select(
            "node",
            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("least_id", "first").alias("component_id"),
        )
    )
    alone = rows.filter("node IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    linked = rows.filter("node IS NOT NULL").select("vec_id", "node").join(of, "node").select("vec_id", "n_links", "component_id")
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("vec_id").eqNullSafe(F.col("component_id"))))
