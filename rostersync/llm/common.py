"""Pieces several operators share: words, packed rows, and Arrow helpers for tasks."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word: a run of characters that are no ASCII white space. ``bytes.split()`` cuts the same runs.
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """All input columns in one struct ``row``, beside ``columns``.

    Nothing an operator adds can then clash with a name of the input; ``row.*`` gives it back.
    """
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(n) for n, c in columns.items()])


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def hash_key(*columns: Column, seed: int = 0) -> Column:
    """Order key of a row, from content only (a task that runs again gives the same): 0 to 2^60 - 1."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 4)


def refuse_names(keep: Iterable[str], results: Iterable[str]) -> None:
    """Kept columns may not be called like results, whatever the case."""
    taken = {r.lower() for r in results}
    clash = [c for c in keep if c.lower() in taken]
    if clash:
        raise ValueError(f"kept columns are called like results: {', '.join(clash)}")


def slices(batches: Iterable[pa.RecordBatch], text: int, most_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts (column number ``text``) of a slice hold about ``most_bytes``.

    A longer text makes a slice of its own; no text is cut.
    """
    for batch in batches:
        sizes = np.array([0 if x is None else x for x in pc.binary_length(batch.column(text)).to_pylist()], np.int64)
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def words_as_ids(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, dict[bytes, int]]:
    """Words of all texts as numbers, the words per text, and the numbering (exact, no hashing)."""
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    flat: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if text:
            words = text.split()
            counts[i] = len(words)
            flat.extend(map(numbers.__getitem__, words))
    return np.array(flat, np.int64), counts, numbers
