"""Registered queries: each operator over its whole table, with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, chat, mixing, quality
from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.divergence import source_divergence
from tidemark.llm.jaccard import jaccard_components
from tidemark.llm.langid import held_out, language_id
from tidemark.llm.linededup import dedup_lines
from tidemark.llm.tokenstore import TokenStore, write_store
from tidemark.llm.toxicity import grade_toxicity
from tidemark.llm.urlfilter import judge_urls
from tidemark.llm.whitening import whiten
from tidemark.shared import fresh_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix(table(spark, sf_dir, "documents"))
    return mix.select("doc.doc_id", "size", "source_size", "target", "taken")


@register
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc.doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@register
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality.verdicts(quality.ledger(table(spark, sf_dir, "documents")))
    return ledger.select(
        "doc.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~F.col("kept_base")).alias("base_failed"),
        F.col("kept_strict").alias("kept"),
        F.col("failed").alias("failed_bits"),
    )


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_table(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """Writes ``docs`` as a token store and reads every document back through its index;
    ``options`` are those of the store's writer."""
    root = fresh_folder(spark, "tokens")
    write_store(docs, root, tokenizer_path(), **options)
    keys = docs.select(F.col("doc_id").cast("long").alias("key")).distinct()
    read = TokenStore(spark, root).documents(keys)
    return read.withColumnRenamed("key", "doc_id")


@register
def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table(spark, table(spark, sf_dir, "documents"))


@register
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = language_id(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc.doc_id",
        held_out(F.col("doc.doc_id")).alias("held_out"),
        "lang_pred",
        "score",
        "bits",
        "rejected",
    )


@register
def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rotated = chat.rotate(table(spark, sf_dir, "conversations"))
    return rotated.select(
        "conv_id",
        "participant",
        "segment",
        "n_turns",
        "n_trained",
        "rendered",
        F.array_join(
            F.transform(
                "mask",
                lambda s: F.concat_ws(
                    ":", s["start"].cast("string"), s["length"].cast("string")
                ),
            ),
            ",",
        ).alias("mask"),
    )


@register
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


@register
def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jaccard_components(table(spark, sf_dir, "documents"))
    return joined.select(F.col("key").alias("doc_id"), "n_shingles", "component_id")


@register
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


@register
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = grade_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc.doc_id", "severity", "grade", "toxic")


@register
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whiten(table(spark, sf_dir, "embeddings"))
    return white.select(
        "doc.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    )


@register
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


@register
def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = tokenizer_path(BYTE_TOKENIZER)
    encoded = bpe.encode(table(spark, sf_dir, "documents"), tokenizer).select(
        "row.doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
    )
    decoded = bpe.decode(encoded, tokenizer, keep=("doc_id", "n_tokens", "ids_sha256"))
    return decoded.select("row.*", F.sha2("text", 256).alias("decoded_sha256"))
