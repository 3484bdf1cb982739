"""The training-data pipeline: documents in, token ids of a clean, mixed corpus out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostersync.llm.common import n_words
from rostersync.llm.language import in_known_language
from rostersync.llm.line_spread import without_shared_lines
from rostersync.llm.mixing import mixture
from rostersync.llm.ngram_join import one_of_each
from rostersync.llm.pieces import encode
from rostersync.llm.queries import tokenizer_path
from rostersync.operators.staging import materialise


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of no language with a clear lead, go."""
    return in_known_language(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that two sources or more share stay in their first document only."""
    return without_shared_lines(docs, min_sites=2)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a similarity of 0.8 in five-word shingles one stays."""
    return one_of_each(docs, size=5, least="0.8")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weigh 5, 2, 1 in turn and share 150 % of all words; documents repeat at most twice."""
    return mixture(docs, n_words(F.col("text")), weights=(5, 2, 1), share=1.5, most=2.0)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the mixed texts."""
    return encode(docs, tokenizer_path("piece_bpe_32k.model"), keep=("doc_id", "lang", "source"))


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("pieces", pieces),
]

#: A trained network, shingle components and a tokenizer have no SQL; tests check each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result but the last written and read again.

    Null, empty and letterless texts go in the first stage. An empty table passes through all stages and
    gives no rows. Null languages and sources are kept; a null source is a source of its own.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
