"""The inventory's expressions over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import inventory as inv


def _docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.concat(F.lit("V"), F.lit("/src-"), "source", F.lit("/doc_"), F.col("doc_id"), F.lit(".sql")).alias("file"), "doc_id", "text")


def file_identity(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", inv.file_id(F.col("file")).alias("file_id"), F.sha2("text", 256).alias("sha256"))


def line_stats(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", inv.line_counts(F.col("text")).alias("c")).select("doc_id", *[F.col(f"c.{x}").cast("long").alias(x) for x in ("total_lines", "code_lines", "blank_lines")])


def hint_signals(spark, sf_dir):
    hints = inv.content_hints(F.concat(F.col("text"), F.when(F.col("doc_id") % 3 == 0, " INSERT INTO t ").otherwise(" create table t ")))
    return _docs(spark, sf_dir).select("doc_id", F.coalesce(hints["has_insert"], F.lit(False)).alias("has_insert"), F.coalesce(hints["has_create_table"], F.lit(False)).alias("has_create_table"))


def role_classification(spark, sf_dir):
    text = F.when(F.col("doc_id") % 4 == 0, "create table a (b number);").when(F.col("doc_id") % 4 == 1, "insert into a values (1);").when(F.col("doc_id") % 4 == 2, "create or replace procedure p is begin null; end;").otherwise("grant select on a to b;")
    hints = inv.content_hints(text)
    return _docs(spark, sf_dir).select("doc_id", inv.file_role(hints, F.col("file")).alias("file_role"))


def inventory_summary(spark, sf_dir):
    rows = inv.summary(inv.inventory(_docs(spark, sf_dir)))
    return rows.groupBy().agg(F.sum("files").alias("files"), F.sum("lines").alias("lines"))


def queries():
    return {f.__name__: f for f in (file_identity, line_stats, hint_signals, role_classification, inventory_summary)}


_LINES = "string_split(CASE WHEN ends_with(text, chr(10)) THEN left(text, length(text) - 1) ELSE text END, chr(10))"


def oracle_sql():
    return {
        "file_identity": "SELECT doc_id, 'DOC_' || doc_id || '__' || upper(left(sha256('V/src-' || source || '/doc_' || doc_id || '.sql'), 8)) AS file_id, sha256(text) AS sha256 FROM documents",
        "line_stats": f"SELECT doc_id, CAST(len({_LINES}) AS BIGINT) AS total_lines, CAST(len(list_filter({_LINES}, lambda x: trim(x) <> '' AND NOT starts_with(trim(x), '--'))) AS BIGINT) AS code_lines, CAST(len(list_filter({_LINES}, lambda x: trim(x) = '')) AS BIGINT) AS blank_lines FROM documents",
        "hint_signals": "SELECT doc_id, doc_id % 3 = 0 AS has_insert, doc_id % 3 <> 0 AS has_create_table FROM documents",
        "role_classification": "SELECT doc_id, ['schema_ddl', 'seed_data', 'procedure', 'mixed'][doc_id % 4 + 1] AS file_role FROM documents",
        "inventory_summary": f"SELECT CAST(count(*) AS BIGINT) AS files, CAST(sum(len({_LINES})) AS BIGINT) AS lines FROM documents",
    }
