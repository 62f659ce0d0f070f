"""The pipeline: each stage on what its predecessor kept."""

import re

import __spark_entry__
import corpus_pipeline
from pyspark.sql import functions as F

from photospark.llm import minhash, passages, quality_rules
from photospark.llm.common import stage as written


def test_stages(spark, sf):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = docs
    seen = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        kept = written(stage(spark, kept, sf), f"test{i}")
        assert kept.columns == docs.columns
        seen.append(kept)
    good = {r.doc_id for r in quality_rules.quality_verdicts(docs).where("kept").collect()}
    assert {r.doc_id for r in seen[0].collect()} == good
    heads = {r.doc_id for r in minhash.near_duplicates(seen[0]).where("kept").collect()}
    assert {r.doc_id for r in seen[1].collect()} == heads
    assert {r.doc_id for r in seen[2].collect()} == heads
    changed = {r.doc_id for r in seen[1].join(seen[2].select("doc_id", F.col("text").alias("new")), "doc_id").where("text <> new").collect()}
    assert changed == {r.doc_id for r in passages.repeated_passages(seen[1]).collect()}
    # A cut joins what stood around it, so that a passage may arise anew; but hardly ever.
    assert passages.repeated_passages(seen[2]).count() <= max(1, len(changed) // 20)
    packed = corpus_pipeline.STAGES[-1][1](spark, seen[2], sf)
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
    assert packed.select("doc_id").distinct().count() == len(heads)


def test_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {m[0] for n in names if (m := re.match(r"op\d+", n))} == {f"op{i}" for i in range(1, 11)}
