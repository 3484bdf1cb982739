"""The registered queries of the numbered operators: name -> (Spark query, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostersync.llm import chunk_reuse
from rostersync.llm import oracle as O
from rostersync.llm.common import n_words
from rostersync.llm.conversations import repair
from rostersync.llm.host_rules import judge
from rostersync.llm.interleave import interleave
from rostersync.llm.language import fit, held_out, identify
from rostersync.llm.lattice import near_vectors
from rostersync.llm.line_spread import drop_shared_lines
from rostersync.llm.mixing import mix
from rostersync.llm.ngram_join import similar_documents
from rostersync.llm.pieces import encode
from rostersync.llm.resample import resample
from rostersync.llm.spelling import counts, occurrences, variants
from rostersync.llm.token_counts import token_counts

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[Query, str | None]] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        REGISTRY[query.__name__] = (query, sql)
        return query

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


@register(O.MIX)
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    mixed = mix(docs, n_words(F.col("text")), weights=(5, 2, 1), shares=(1.5,), most=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@register(O.LINE_SPREAD)
def op2_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = drop_shared_lines(_table(spark, sf_dir, "documents"), min_sites=3)
    return cleaned.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", F.md5("clean").alias("clean_md5"))


@register()
def op3_lattice_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"), least=0.98)


@register(O.HOST_RULES)
def op4_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(_table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@register()
def op5_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = interleave(_table(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )


@register()
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    named = identify(docs, fit(docs))
    return named.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@register()
def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@register()
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


@register()
def op9_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets are documents labelled good; as large a share is kept as they have of the labels."""
    labels = _table(spark, sf_dir, "labels")
    good = F.coalesce(F.col("quality") == 1, F.lit(False))
    share = labels.agg(F.avg(good.cast("int"))).first()[0]
    learned = labels.filter(good & ~held_out(F.col("doc_id"))).select("doc_id")
    return resample(_table(spark, sf_dir, "documents"), learned, share or 0.0)


@register()
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(_table(spark, sf_dir, "documents"), size=5, least="0.8")


def misspelt(runs: DataFrame) -> DataFrame:
    """One run in 97, by its checksum with the document, loses a letter; a null ``doc_id`` reads as an empty one."""
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "word")
    h = F.crc32(name.cast("binary"))
    k = (h % F.length("word")).cast("int")
    shorter = F.concat(F.left("word", k), F.substring("word", k + 2, F.length("word")))
    return runs.select("doc_id", F.when(h % 97 == 0, shorter).otherwise(F.col("word")).alias("word"))


@register()
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs shorter than five letters have no part in it, whether they lose one or not."""
    runs = misspelt(occurrences(_table(spark, sf_dir, "documents"), least_letters=5))
    return variants(counts(runs, least_letters=5, least=3))


@register()
def op12_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = chunk_reuse.encode(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), decoded=True)
    ids = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    return tokens.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Faults put in by the rows' own checksums; nulls read as one space (a null turn stays one where rows are put in order)."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    what = F.crc32(name.cast("binary")) % 20
    return (
        conversations.select("conv_id", "turn", what.alias("what"), role.alias("role"), text.alias("text"))
        .filter("what <> 0")
        .select(
            "conv_id", "turn", F.when(F.col("what") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.array_repeat(F.lit(0), F.when(F.col("what") == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )


@register()
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    lines = F.transform("repaired", lambda turn: F.concat(F.coalesce(turn["role"], F.lit("")), F.lit(":"), F.coalesce(turn["text"], F.lit(""))))
    mended = repair(damaged(conversations)).select(
        F.col("conv_id").alias("c"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.sha2(F.array_join(lines, "\n").cast("binary"), 256).alias("repaired_sha256"),
    )
    every = conversations.select("conv_id").distinct()
    none = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    none |= {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256))}
    return every.join(mended, F.col("conv_id").eqNullSafe(F.col("c")), "left").select("conv_id", *[v.alias(k) for k, v in none.items()])
