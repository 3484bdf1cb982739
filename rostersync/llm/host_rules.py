"""Quality rules per document, and verdicts per host from shrunk failure rates.

Tasks count words, lines and symbols of whole texts; Spark sums rule failures per host. A host with few
documents has an unreliable rate, so each rule's rates over all hosts give a beta prior (by moments),
and a host's rate is its posterior mean. A host that fails a rule too often is rejected, and so are its
documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostersync.llm.common import col, slices, words_as_ids
from rostersync.operators.staging import broadcast_if_small, materialise

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

#: A rule holds for a document that fails it. The first two reject by themselves.
RULES: dict[str, str] = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "same_lines": "10 * n_dup_lines > 3 * n_lines",
    "odd_words": "n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 12 * n_words)",
}
BASE = ("short", "repeats")


def repeated_words(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text, the words that lie in a window of 3 words found at least twice in that text."""
    n, distinct = len(ids), int(ids.max(initial=-1)) + 1
    if n < 3:
        return np.zeros(len(counts), np.int64)
    text = np.repeat(np.arange(len(counts)), counts)
    inside = np.flatnonzero(text[2:] == text[:-2])
    pair = ids[:-1] * distinct + ids[1:]
    if distinct > 2_000_000:  # three numbers no longer fit in 63 bits: number the pairs first
        pair = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    window = pair[inside] * distinct + ids[inside + 2]
    order = np.lexsort((window, text[inside]))
    at, window = text[inside][order], window[order]
    same = (window[1:] == window[:-1]) & (at[1:] == at[:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    starts = inside[order[twice]]
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[starts + k] = True
    return np.bincount(text[hit], minlength=len(counts))


def _line_counts(text: bytes) -> tuple[int, int]:
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines), len(lines) - len(set(lines))


def count_batch(texts: pa.Array) -> list[np.ndarray]:
    """The counts of ``COUNTS`` for an array of strings; a null counts as no text."""
    texts = pc.fill_null(texts, "")
    raw = texts.cast(pa.binary()).to_pylist()
    ids, words, _ = words_as_ids(raw)
    ask = lambda chars: sum(pc.count_substring(texts, c).to_numpy(zero_copy_only=False).astype(np.int64) for c in chars)
    chars = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) - ask(BLANKS)
    lines = np.array([_line_counts(x) for x in raw], np.int64).reshape(-1, 2)
    return [words, chars, ask(SYMBOLS), lines[:, 0], lines[:, 1], repeated_words(ids, words)]


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 2, 8 << 20):
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *[pa.array(x, pa.int64()) for x in count_batch(batch.column(2))]],
            names=["doc_id", "host", *COUNTS],
        )


def document_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str | Column = "source") -> DataFrame:
    """``doc_id``, ``host`` and the counts of every whole text."""
    site = col(host) if isinstance(host, str) else host
    rows = docs.select(col(doc_id).cast("long").alias("doc_id"), site.cast("string").alias("host"), col(text).cast("string").alias("text"))
    return rows.mapInArrow(_count, "doc_id long, host string, " + ", ".join(f"{c} long" for c in COUNTS))


def shrunk_rates(fails: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """(host, n, fails per rule) -> host and its shrunk rate per rule.

    With mean m and variance v of the rates over hosts (weighted by documents), the prior's weight is
    m (1 - m) / v - 1 documents, at least 1 and at most a million (rates that do not differ).
    """
    moments = []
    for rule in rules:
        rate = F.col(rule) / F.col("n")
        moments += [
            (F.sum(rule) / F.sum("n")).alias(f"m_{rule}"),
            (F.sum(F.col("n") * rate * rate) / F.sum("n")).alias(f"s_{rule}"),
        ]
    prior = fails.agg(*moments).first()  # one row
    rates = []
    for rule in rules:
        mean = prior[f"m_{rule}"] or 0.0
        spread = max((prior[f"s_{rule}"] or 0.0) - mean * mean, 1e-12)
        weight = min(max(mean * (1 - mean) / spread - 1, 1.0), 1e6)
        rates.append(((F.col(rule) + F.lit(weight * mean)) / (F.col("n") + F.lit(weight))).alias(rule))
    return fails.select("host", *rates)


def judge(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str | Column = "source",
    rules: Mapping[str, str] = RULES,
    base: tuple[str, ...] = BASE,
    most: float = 0.5,
) -> DataFrame:
    """Counts, ``base_failed``, ``host_failed``, ``host_rate`` (the worst rule's) and ``kept`` per document.

    A host is rejected when its shrunk failure rate of any rule is above ``most``, that is, when more
    of its documents fail than pass. A null host forms no group and has no verdict. A null or empty
    text has no words and fails ``short``. One row per input row; repeated rows are judged alike; an
    empty table gives no rows. Other columns are not looked at.
    """
    counted = materialise(document_counts(docs, doc_id, text, host), "quality-counts")
    fails = (
        counted.filter("host IS NOT NULL")
        .groupBy("host")
        .agg(F.count("*").alias("n"), *[F.sum(F.expr(f"int({test})")).alias(rule) for rule, test in rules.items()])
    )
    rates = shrunk_rates(materialise(fails, "quality-hosts"), rules)
    worst = F.greatest(*[F.col(r) for r in rules]) if len(rules) > 1 else F.col(next(iter(rules)))
    verdicts = materialise(rates.select(F.col("host").alias("of"), worst.alias("host_rate")), "quality-verdicts")
    failed = F.expr(" OR ".join(f"({rules[r]})" for r in base)) if base else F.lit(False)
    return (
        counted.join(broadcast_if_small(verdicts), counted["host"] == verdicts["of"], "left")
        .withColumn("base_failed", failed)
        .withColumn("host_failed", F.coalesce(F.col("host_rate") > most, F.lit(False)))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))
        .drop("of")
    )
