"""The query of each operator over its whole table, and its SQL twin where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from photospark.llm import bpe_codec, class_lm, embedding_join, hard_negatives, license_scans, minhash, packing, passages, quality_rules, token_counts, url_filters, warc, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.embedding_links(_table(spark, sf_dir, "embeddings"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), _tokenizer())


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(_table(spark, sf_dir, "documents"), _tokenizer())


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.codec_digests(_table(spark, sf_dir, "documents"), _tokenizer())


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(_table(spark, sf_dir, "documents"))


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, looked up by its URL through both levels of the index."""
    pages = _table(spark, sf_dir, "pages")
    return warc.write_captures(pages).lookup(pages, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scans.license_scan(_table(spark, sf_dir, "documents"))


def op9_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return class_lm.class_scores(docs, F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 != 2)


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(hard_negatives.shifted_labels(_table(spark, sf_dir, "embeddings")))


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.url_filter(_table(spark, sf_dir, "pages"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_embedding_near_dedup, op2_token_counts, op3_best_fit_packing, op4_bpe_codec, op5_quality_rules, op6_repeated_passages, op7_warc, op8_license_scans, op9_class_lm, op10_minhash_near_dedup,
        op11_whitening, op12_hard_negatives, op13_url_filters,
    )
}
ORACLES: dict[str, str] = {"op1_embedding_near_dedup": embedding_join.SQL, "op5_quality_rules": quality_rules.SQL, "op12_hard_negatives": hard_negatives.SQL}
