"""Importance resampling: which raw documents look like the target, by hashed n-gram models.

Words and word pairs of all documents are counted in hash buckets, more of them for more documents, and so are those of a bounded sample
of labelled target documents. A document's log weight is the sum, over its words and pairs, of the log
ratio of the two models. Gumbel noise made of the id is added, and the k largest are the sample.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostersync.llm.common import col, hash_key, slices, words_as_ids
from rostersync.operators.staging import materialise

#: Hash buckets of the models, within bounds: as the different words of a text do, they grow with the
#: square root of the documents, so that what tasks send grows little faster than what they read. The
#: ratios are broadcast, 8 bytes a bucket.
LEAST_BUCKETS, MOST_BUCKETS, PER_ROOT = 1 << 14, 1 << 20, 64
#: Bound of the sample the target model is fitted on (those with the smallest hashes of their ids).
TARGET_DOCS = 20_000
BINS, FEW = 4096, 10_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def buckets_for(documents: int) -> int:
    """A power of two that grows with the square root of the documents, up to ``MOST_BUCKETS``."""
    wanted = PER_ROOT * math.isqrt(documents)
    return min(max(LEAST_BUCKETS, 1 << max(0, wanted - 1).bit_length()), MOST_BUCKETS)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    keys = keys * MIX
    keys ^= keys >> np.uint64(31)
    return (keys * MIX >> np.uint64(33)).astype(np.int64) % buckets


def grams(texts: list[bytes | None], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and word pairs, and the number of the text each is in."""
    ids, counts, numbers = words_as_ids([t.lower() if t else t for t in texts])
    hashes = np.fromiter(map(zlib.crc32, numbers), np.uint64, len(numbers)) + np.uint64(1)
    words = hashes[ids] if len(ids) else np.zeros(0, np.uint64)
    text = np.repeat(np.arange(len(texts)), counts)
    inside = np.flatnonzero(text[1:] == text[:-1])
    pairs = words[inside] * np.uint64(1 << 32) + words[inside + 1]
    return np.concatenate([_bucket(words, buckets), _bucket(pairs, buckets)]), np.concatenate([text, text[inside]])


def _count(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, buckets), np.int64)
    for batch in slices(batches, 0, 8 << 20):
        found, text = grams(pc.fill_null(batch.column(0), "").cast(pa.binary()).to_pylist(), buckets)
        wanted = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)[text]
        total[0] += np.bincount(found, minlength=buckets)
        total[1] += np.bincount(found[wanted], minlength=buckets)
    some = np.flatnonzero(total[0])
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0][some]), pa.array(total[1][some])], names=["bucket", "raw", "target"])


def ratios(docs: DataFrame, text: str, is_target: Column, buckets: int) -> np.ndarray:
    """Log ratio of the smoothed target and raw frequency of each bucket."""
    rows = docs.select(col(text).cast("string").alias("text"), F.coalesce(is_target, F.lit(False)).alias("wanted"))
    counts = rows.mapInArrow(partial(_count, buckets=buckets), "bucket long, raw long, target long").groupBy("bucket")
    table = counts.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()  # at most `buckets` rows of numbers
    models = np.ones((2, buckets))
    at = table["bucket"].to_numpy()
    models[0, at] += table["raw"].to_numpy()
    models[1, at] += table["target"].to_numpy()
    models /= models.sum(axis=1, keepdims=True)
    return np.log(models[1]) - np.log(models[0])


def kth_largest(values: DataFrame, name: str, k: int) -> float:
    """The k-th largest of a column without nulls, exactly; infinity for k < 1, minus infinity beyond all.

    Counts per bin, then again within the bin that holds it, until few values are left.
    """
    n, low, high = values.agg(F.count(name), F.min(name), F.max(name)).first()
    if k < 1:
        return float("inf")
    if k >= n:
        return float("-inf")
    v = F.col(name)
    while n > FEW and low < high:
        inside = values.filter((v >= low) & (v <= high))
        bin_ = F.least(F.floor((v - low) / (high - low) * BINS), F.lit(BINS - 1))
        bins = inside.groupBy(bin_.alias("bin")).agg(F.count("*"), F.min(v), F.max(v)).collect()  # at most BINS rows
        for _, n, low, high in sorted(bins, reverse=True):
            if n >= k:
                break
            k -= n
    if low == high:
        return low
    rest = values.filter((v >= low) & (v <= high)).orderBy(v.desc()).limit(k).select(name).collect()  # at most FEW rows
    return rest[-1][0]


def resample(
    docs: DataFrame,
    target_ids: DataFrame,
    share: float,
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = 9,
    buckets: int | None = None,
) -> DataFrame:
    """``doc_id``, ``log_weight`` and ``kept`` of every row; about ``share`` of the rows with words are kept.

    ``target_ids`` (one column ``doc_id``) names target documents; ``TARGET_DOCS`` of them at most are
    learned from, the raw model counts all documents. Words and word pairs share ``buckets`` hash buckets,
    by default a power of two that grows with the square root of the documents, from 16,384 up to 1,048,576.
    A text that is null or has no words has a null
    weight and is not kept. Rows with one id and text get one weight and one draw, so they are kept or
    left together; at a tie on the last place all tied rows stay. An empty table gives no rows, and
    without targets the order is that of the noise. Other columns are not looked at.
    """
    chosen = target_ids.select(F.col("doc_id").alias("of")).filter("of IS NOT NULL").distinct()
    chosen = chosen.orderBy(hash_key(F.col("of"), seed=1), "of").limit(TARGET_DOCS)
    own = col(doc_id)
    marked = docs.select(own.alias("id"), col(text).alias("text")).join(F.broadcast(materialise(chosen, "targets")), F.col("id") == F.col("of"), "left")
    buckets = buckets_for(docs.count()) if buckets is None else buckets
    shared = docs.sparkSession.sparkContext.broadcast(ratios(marked, "text", F.col("of").isNotNull(), buckets))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = shared.value
        for batch in slices(batches, 1, 8 << 20):
            found, at = grams(pc.fill_null(batch.column(1), "").cast(pa.binary()).to_pylist(), buckets)
            n = batch.num_rows
            some = np.bincount(at, minlength=n) > 0
            weight = np.bincount(at, ratio[found], minlength=n)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(weight, pa.float64(), mask=~some)], names=["doc_id", "key", "log_weight"])

    rows = docs.select(own.cast("long").alias("doc_id"), col(text).cast("string").alias("text"), F.xxhash64(F.lit(seed), own, col(text)).alias("key"))
    weighted = rows.mapInArrow(run, "doc_id long, key long, log_weight double")
    chance = (F.shiftrightunsigned("key", 11) + 0.5) / F.lit(2.0**53)
    drawn = materialise(weighted.withColumn("draw", F.col("log_weight") - F.log(-F.log(chance))).drop("key"), "draws")
    some = drawn.filter("draw IS NOT NULL")
    least = kth_largest(some, "draw", round(share * some.count()))
    return drawn.select("doc_id", "log_weight", F.coalesce(F.col("draw") >= least, F.lit(False)).alias("kept"))
