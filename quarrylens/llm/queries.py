"""The operators over their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, decontam, licenses, merkle, mixing, neardup, pii, quality, secrets, structure, syncmers, toxicity, urlfilter
from .common import tables

RULES = [
    urlfilter.Rule("com", "/", "allow"),
    urlfilter.Rule("example.com", "/en/", "block"),
    urlfilter.Rule("www.example.com", "/en/", "allow"),
    urlfilter.Rule("net", "/es/", "block"),
    urlfilter.Rule("net", "/fr/", "block"),
]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents")
    model = toxicity.fit_on_labels(docs, tables(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", toxicity.is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.scrub(docs, with_counts=True)


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair_roles(tables(spark, sf_dir, "conversations"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.scan_benchmark(tables(spark, sf_dir, "documents"), tables(spark, sf_dir, "benchmark"))


def op5_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicate_classes(tables(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_shingles")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(tables(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(tables(spark, sf_dir, "documents"), secrets.train(spark))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(tables(spark, sf_dir, "documents"), tables(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(tables(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.filter_urls(tables(spark, sf_dir, "pages"), RULES)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(tables(spark, sf_dir, "documents"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.damage_and_repair(tables(spark, sf_dir, "conversations"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprint_report(tables(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_pii, op3_chat, op4_decontamination, op5_neardup, op6_licenses, op7_secrets, op8_quality, op9_mixing, op10_urls, op11_merkle, op12_conversations, op13_fingerprints)}
