"""Registered queries of this subpackage, one per operator, and the SQL that checks them where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonalis.llm import (
    centroid_clustering,
    compression_quality,
    context_mixing,
    decontaminate,
    mixing,
    near_duplicates,
    quality_rules,
    quotation,
    records,
    repeated_spans,
    sharding,
    suffix_trees,
    token_alignment,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = function
        if sql:
            CHECKS[name] = sql
        return function

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def remainder(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5: the fold of a document."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5, F.lit(-1))


@register("op10_quality_rules", quality_rules.CHECK_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of all documents under the current policy."""
    book = quality_rules.apply_policy(quality_rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "fail_bits"
    )


@register("op7_near_duplicates")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near duplicates over four-word shingles at similarity 0.8."""
    classes = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), words=4)
    return classes.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"), "is_first")


@register("op3_decontaminate", decontaminate.CHECK_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents inside occurrences of 13-word benchmark windows."""
    report, _ = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return report.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


@register("op4_mixing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes each document."""
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"))


@register("op6_binary_records")
def op6(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Ids of all documents, written as records and read back."""
    index = records.tokenize_to_records(table(spark, sf_dir, "documents"), tokenizer or tokenizer_file())
    return index.select("doc_id", "start", "n_tokens", "ids_crc32")


@register("op8_sharding")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen shards of near-equal bytes."""
    placed = sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@register("op1_context_mixing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents; documents of fold 1 are not learnt from."""
    scored = context_mixing.score_texts(table(spark, sf_dir, "documents"), remainder() != 1, kind="lang")
    return scored.select(
        "doc_id", (remainder() == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte"
    )


@register("op2_repeated_spans")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of repeated 200-byte strings."""
    cleaned = repeated_spans.remove_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@register("op5_compression_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents; labels of fold 0 are not learnt from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(remainder() != 0).select("doc_id", "quality")
    scorer = compression_quality.fit(docs, labels, "quality")
    scored = compression_quality.score(docs, scorer)
    return scored.select(
        "doc_id", (remainder() == 0).alias("held_out"), "score", (F.col("score") >= compression_quality.CUT).cast("int").alias("predicted"),
        "n_bytes", "good_size", "bad_size",
    )


@register("op9_quotation", quotation.CHECK_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages in reply order without their quotes."""
    return quotation.conversations(table(spark, sf_dir, "conversations"))


@register("op11_centroid_clustering", centroid_clustering.CHECK_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight clusters of all vectors after ten rounds."""
    labelled, centroids = centroid_clustering.cluster_vectors(table(spark, sf_dir, "embeddings"))
    return centroid_clustering.with_inertia(labelled, centroids).select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


@register("op12_suffix_trees", suffix_trees.CHECK_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of 20-word windows that occur earlier."""
    cleaned = suffix_trees.remove_earlier(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", "kept_sha256")


@register("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str, a_file: str | None = None, b_file: str | None = None) -> DataFrame:
    """Tokens of two public tokenizers aligned in all documents."""
    aligned = token_alignment.align(table(spark, sf_dir, "documents"), a_file or tokenizer_file(), b_file or tokenizer_file("piece_bpe_32k.model"))
    counted = token_alignment.with_counts(aligned, token_alignment.pair_counts(aligned))
    return counted.select(
        F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps"
    )
