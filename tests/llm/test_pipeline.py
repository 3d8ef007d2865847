"""The whole pipeline against a plain version on the small table."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import components_by_force, contamination_by_force, texts_of


def test_pipeline_keeps_what_a_plain_version_keeps(spark, small):
    from tokenizers import Tokenizer

    from zonalis.llm.queries import tokenizer_file

    docs = spark.read.parquet(f"{small}/documents.parquet")
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    stages = dict(corpus_pipeline.STAGES)
    ruled = stages["quality rules"](spark, docs, small).cache()
    assert ruled.columns == docs.columns
    texts = texts_of(ruled)
    first = {i for i, (_, root) in components_by_force(texts, 5).items() if i == root}
    unique = stages["MinHash near-dedup"](spark, ruled, small).cache()
    assert {r[0] for r in unique.select("doc_id").collect()} == first and unique.columns == docs.columns
    force = contamination_by_force(texts_of(unique), items)
    clean = {i for i, (n, hit, *_) in force.items() if not (hit and 20 * hit >= n)}
    kept = stages["benchmark decontamination"](spark, unique, small).cache()
    assert {r[0] for r in kept.select("doc_id").collect()} == clean and kept.columns == docs.columns
    mixed = stages["mixing sources to target weights"](spark, kept, small).cache()
    assert mixed.columns == docs.columns and mixed.exceptAll(kept.unionByName(kept)).count() == 0
    out = stages["token-ID / binary output"](spark, mixed, small).orderBy("start").collect()
    plain, start = Tokenizer.from_file(tokenizer_file()), 0
    for r, (name, text) in zip(out, sorted(texts_of(mixed)), strict=True):
        ids = np.array([*plain.encode(text.decode(), add_special_tokens=False).ids, 2], "<u4")
        assert (r["doc_id"], r["start"], r["ids_crc32"]) == (name, start, zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert [name for name, _ in corpus_pipeline.STAGES] == list(stages) and len(stages) == 5


def test_extra_columns_pass_through(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(60).withColumns(
        {c: F.lit(f"own {c}") for c in ("size", "n_words", "kept", "repeats", "id", "target", "fail_bits")}
    )
    stages = dict(corpus_pipeline.STAGES)
    for name in ("quality rules", "MinHash near-dedup", "benchmark decontamination", "mixing sources to target weights"):
        out = stages[name](spark, docs, small)
        assert out.columns == docs.columns
        assert {tuple(r) for r in out.select("size", "kept", "id").distinct().collect()} <= {("own size", "own kept", "own id")}


def test_repeated_rows_are_kept_once_and_others_are_not_grouped(spark):
    words = [" ".join(f"w{n}{k}" for k in range(30)) for n in range(4)]
    rows = [(1, words[0], "a"), (1, words[0], "b"), (1, words[1], "a"), (2, words[0], "a"), (3, words[2], "a"), (None, words[3], "a"), (None, words[3], "a"), (4, "", "a"), (4, None, "a")]
    stage = corpus_pipeline.near_duplicates_stage
    kept = stage(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), "").collect()
    got = sorted((r.doc_id or 0, r.text or "") for r in kept)
    assert got == sorted([(1, words[0]), (1, words[1]), (3, words[2]), (0, words[3]), (0, words[3]), (4, "")])
    plans = stage(spark, spark.createDataFrame([r for r in rows if r[2] == "a" and r[1]], "doc_id long, text string, source string"), "")
    assert "Aggregate" not in plans._jdf.queryExecution().optimizedPlan().toString()
