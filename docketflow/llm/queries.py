"""The registered queries: each operator over its whole table, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.llm import (
    divergence,
    html_extraction,
    license_scan,
    line_dedup,
    lm_scoring,
    merkle,
    minhash,
    mixing,
    packing,
    quality_rules,
    sentencepiece_codec,
    substring_dedup,
    topk_search,
)
from docketflow.llm.common import load, piece_model, word_tokenizer
from docketflow.llm.oracle import ORACLE_SQL


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(load(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    mixed, sizes, wanted = mixing.mix(docs, F.array("source"))
    named = mixing.with_sources(mixed, F.col("doc.source"), sizes, wanted)
    return named.select(
        F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target", "taken", "passes"
    )


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepiece_codec.encode_decode(load(spark, sf_dir, "documents"), piece_model())
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with its most probable licence, all its licences and their paragraphs."""
    found = license_scan.scan(load(spark, sf_dir, "documents"))
    best = F.array_max(F.transform("licenses", lambda x: F.struct(x["probability"], x["family"])))
    return found.select(
        "doc_id",
        best["family"].alias("license"),
        F.array_join(F.array_sort(F.array_distinct("licenses.family")), ",").alias("licenses"),
        F.size("licenses").cast("long").alias("n_paragraphs"),
        best["probability"].alias("probability"),
    )


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings")
    return topk_search.top_k(rows, F.col("vec_id") % 50 == 0)


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_extraction.extract(load(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(load(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicate_classes(load(spark, sf_dir, "documents"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(load(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs, F.col("source"), counts=True)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_manifest(load(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(load(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(load(spark, sf_dir, "documents"), word_tokenizer())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_substring_dedup,
        op2_source_mixing,
        op3_sentencepiece,
        op4_license_scan,
        op5_exact_topk,
        op6_html_extraction,
        op7_quality_rules,
        op8_near_dedup,
        op9_lm_scoring,
        op10_line_dedup,
        op11_merkle_manifest,
        op12_source_divergence,
        op13_packing,
    )
}

__all__ = ["ORACLE_SQL", "QUERIES"]
