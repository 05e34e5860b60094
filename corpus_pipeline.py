"""The corpus pipeline: each stage takes (spark, docs, sf_dir) and works on what its predecessor wrote.

quality rules -> near-duplicates (one document of each class stays) -> benchmark decontamination -> personal data -> mix.
All but the last return the columns of their input; the last adds the copy's number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarrylens.llm import decontam, mixing, neardup, pii, quality
from quarrylens.llm.common import Scratch, tables


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_quality(docs, tables(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one_per_class(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, tables(spark, sf_dir, "benchmark"))


def scrub_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.scrub(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("scrub_personal_data", scrub_personal_data), ("mix_sources", mix_sources)]
#: Near-duplicate classes and keyed surrogates aren't SQL: tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet in the shared folder and read again."""
    scratch, docs = Scratch(spark), tables(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.table(stage(spark, docs, sf_dir), f"{k}-{name}")
    return docs
