"""Preparation of a training corpus: stages over ``documents``, each reading what the stage before it has kept.

Nulls and clashing columns: a null or empty text fails the quality rules and goes; extra columns are carried through every
stage but the last and never read. Repeated rows are exact copies, of which the near-duplicate stage keeps one.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from zonalis.llm import decontaminate, mixing, near_duplicates, quality_rules, records  # noqa: E402
from zonalis.llm.queries import tokenizer_file  # noqa: E402
from zonalis.plans.materialize import materialize  # noqa: E402
from zonalis.session import shared_dir  # noqa: E402


def packed(docs: DataFrame) -> DataFrame:
    """The columns that operators read, and the whole row beside them, so that no new column can clash with an old one."""
    return docs.select(F.struct(*docs.columns).alias("__row"), "doc_id", "text", "source")


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps."""
    return quality_rules.apply_policy(quality_rules.ledger(packed(docs))).filter("kept").select("__row.*")


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document, by id and a hash of the text, of every class of near duplicates (five-word shingles, similarity 0.8)."""
    firsts = near_duplicates.near_duplicates(docs).filter("is_first AND doc_id IS NOT NULL")
    firsts = materialize(firsts.groupBy("doc_id", F.col("text_key").alias("__key")).agg(F.count(F.lit(1)).alias("__n")))
    marked = docs.withColumn("__key", near_duplicates.text_key())
    names = ["doc_id", "__key"]
    kept = marked.join(firsts.filter("__n = 1").select(names), names, "left_semi")
    again = firsts.filter("__n > 1").select(names)
    if not again.isEmpty():  # exact repeats of a row; whole texts are not grouped where there are none
        kept = kept.unionByName(marked.join(again, names, "left_semi").dropDuplicates(names))
    return kept.select(docs.columns).unionByName(docs.filter("doc_id IS NULL"))  # without an id there is nothing to decide on


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    report, _ = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    dirty = report.filter("contaminated").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (near_duplicates.text_key() == F.col("__key"))
    return docs.join(dirty, same, "left_anti").select(docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; copies of a document are rows of the same id."""
    mixed = mixing.mix(packed(docs))
    taken = mixed.filter("repeats > 0").select("__row", F.explode(F.array_repeat(F.lit(1), F.col("repeats").cast("int"))))
    return taken.select("__row.*")


def records_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Binary records of token ids; one row per record as read back."""
    index = records.tokenize_to_records(docs, tokenizer_file())
    return index.select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", rules_stage),
    ("MinHash near-dedup", near_duplicates_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
    ("token-ID / binary output", records_stage),
]

#: SQL has no byte-level BPE, so the rows of run() are tested against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
