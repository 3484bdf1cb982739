"""Token counts by a two-tier lookup of pre-token lengths, inside the map tasks.

A byte-level BPE never joins across pre-tokens, so a text's token count is the sum over its pre-tokens.
Tier one is a broadcast table of the most frequent pre-tokens and their lengths, at most ``frequent``
entries, counted on a bounded sample. Tier two is a cache in each Python worker, filled by the tokenizer.
No pre-token is shuffled. The sample only decides what is fast, never a count.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rostersync.llm.common import col

#: Fixed value: the pre-token pattern of the byte-level tokenizers this operator reads.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: How a tokenizer file names that pattern.
PLAIN_SPLITS = tuple(
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": trim, "use_regex": True} for trim in (True, False)
)
FREQUENT = 50_000
SAMPLE_DOCS, SAMPLE_CHARS = 4_000, 16_384
CACHE = 400_000

_split = regex.compile(PATTERN)
# Up to here every library's Unicode tables agree; beyond, they differ in characters they do not know.
_far = regex.compile("[^\x00-՗]")


def _all_known(text: str) -> bool:
    return not _far.search(text) or all(unicodedata.category(c) != "Cn" for c in set(text))


class Lengths(dict):
    """Pre-token -> number of tokens; unknown ones are encoded, and forgotten when the cache is full."""

    def __init__(self, tokenizer: Tokenizer, frequent: dict[str, int], most: int = CACHE):
        super().__init__(frequent)
        self.tokenizer, self.frequent, self.most = tokenizer, frequent, most + len(frequent)

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
            self.update(self.frequent)
        length = len(self.tokenizer.encode(word, add_special_tokens=False).ids)
        if len(word) <= 256:  # a long run is rarely met again
            self[word] = length
        return length


class Counting:
    """Counts tokens in tasks; pickles as the tokenizer's text and the packed table."""

    def __init__(self, model: str, words: bytes, lengths: np.ndarray):
        self.model, self.words, self.lengths = model, words, lengths

    def open(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(self.model)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        names = self.words.decode().split("\0") if self.words else []
        self.known = Lengths(self.tokenizer, dict(zip(names, self.lengths.tolist(), strict=True)))
        # A tokenizer that prepares or splits texts in another way is left to the library.
        spec = json.loads(self.model)
        self.own = spec.get("normalizer") is None and spec.get("pre_tokenizer") in PLAIN_SPLITS
        special = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def count(self, text: str) -> int:
        if not self.own or self.special and self.special.search(text) or not _all_known(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return sum(map(self.known.__getitem__, _split.findall(text)))

    def __getstate__(self) -> tuple:
        return self.model, self.words, self.lengths

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)


def _sampled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            found.update(w for w in _split.findall(text) if len(w) <= 64 and "\0" not in w)
    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])


def frequent_words(docs: DataFrame, doc_id: str, text: str, most: int, sample_docs: int, sample_chars: int) -> list[str]:
    """The most frequent pre-tokens of about ``sample_docs`` rows, of each a window of ``sample_chars``.

    Rows are drawn by a hash of id and text, so copies with ids of their own are drawn one by one. Their
    pre-tokens are counted by one aggregation; what it can hold is bounded by the windows.
    """
    every = max(1, docs.count() // sample_docs)
    body, key = col(text), F.xxhash64(col(text))
    window = F.substring(body, (F.pmod(key, F.greatest(F.length(body) - sample_chars, F.lit(0)) + 1) + 1).cast("int"), F.lit(sample_chars))
    drawn = F.pmod(F.xxhash64(F.lit(1), col(doc_id), body), F.lit(every)) == 0
    sample = docs.filter(body.isNotNull() & drawn).select(window.alias("text"))
    counted = sample.mapInArrow(_sampled, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [r["word"] for r in counted.orderBy(F.desc("n"), "word").limit(most).collect()]


def token_counts(
    docs: DataFrame,
    tokenizer_file: str,
    doc_id: str = "doc_id",
    text: str = "text",
    frequent: int = FREQUENT,
    sample_docs: int = SAMPLE_DOCS,
    sample_chars: int = SAMPLE_CHARS,
) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every whole text, as the library counts them.

    No special tokens are added; strings of special tokens inside a text count as the library does by
    default, there is no truncation or padding. A null text counts as an empty one: 0 bytes, 0 tokens.
    One row per input row, repeated or not; an empty table gives no rows. Other columns are not looked
    at. The driver reads the file (of the library's JSON form) and sends it to the tasks. Files that split
    texts by another pattern or normalize them first are counted by the library, text by text.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        model = file.read()
    names = frequent_words(docs, doc_id, text, frequent, sample_docs, sample_chars)
    opened = Counting(model, b"", np.zeros(0, np.uint16))
    opened.open()
    lengths = np.array([len(opened.tokenizer.encode(w, add_special_tokens=False).ids) for w in names], np.uint16)
    # At most `frequent` words of at most 64 characters, and the tokenizer's file.
    shared = docs.sparkSession.sparkContext.broadcast(Counting(model, "\0".join(names).encode(), lengths))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting = shared.value
        if not hasattr(counting, "known"):
            counting.open()
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            n_bytes = pc.cast(pc.binary_length(texts), pa.int64())
            tokens: list[int] = []
            for start in range(0, len(texts), 256):
                tokens += map(counting.count, texts.slice(start, 256).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, pa.array(tokens, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
