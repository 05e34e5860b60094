"""Inventory of a source tree: files, identities, line counts, content signals, roles and the roll-up.

Everything is a DataFrame expression over (file, text); no text leaves the engine.
"""

from __future__ import annotations

import re
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# Default exclusions, and the content signals that the documents name with the pattern each stands for.
EXCLUDED = ("*.bak", "*.tmp", "*_backup.*", "*_old.*", ".git/*", "node_modules/*", "__pycache__/*")
SIGNALS = {
    "has_create_table": r"(?i)\bcreate\s+(global\s+temporary\s+)?table\b",
    "has_create_view": r"(?i)\bcreate\s+(or\s+replace\s+)?(materialized\s+)?view\b",
    "has_create_index": r"(?i)\bcreate\s+(unique\s+)?index\b",
    "has_create_sequence": r"(?i)\bcreate\s+sequence\b",
    "has_create_synonym": r"(?i)\bcreate\s+(or\s+replace\s+)?(public\s+)?synonym\b",
    "has_grant": r"(?im)^\s*grant\b",
    "has_package": r"(?i)\bcreate\s+(or\s+replace\s+)?package\b",
    "has_procedure": r"(?i)\bprocedure\s+\w+",
    "has_function": r"(?i)\bfunction\s+\w+",
    "has_trigger": r"(?i)\bcreate\s+(or\s+replace\s+)?trigger\b",
    "has_insert": r"(?i)\binsert\s+into\b",
    "has_dynamic_sql": r"(?i)\bexecute\s+immediate\b",
    "has_dbms_calls": r"(?i)\bdbms_\w+\.",
    "has_commit": r"(?i)\bcommit\b",
    "has_exception_block": r"(?i)\bexception\s+when\b",
    "has_cursor": r"(?i)\bcursor\s+\w+\s+is\b",
    "has_db_link": r"(?i)\w@\w+",
    "is_wrapped": r"(?i)\bwrapped\b\s*\n",
    "has_alter_table": r"(?i)\balter\s+table\b",
    "has_merge": r"(?i)\bmerge\s+into\b",
    "has_bulk_collect": r"(?i)\bbulk\s+collect\b",
    "has_forall": r"(?i)\bforall\b",
    "has_autonomous_transaction": r"(?i)\bpragma\s+autonomous_transaction\b",
    "has_pipelined": r"(?i)\bpipelined\b",
    "has_hierarchical_query": r"(?i)\bconnect\s+by\b",
}


def _glob(pattern: str) -> str:
    return "^" + "".join(".*" if c == "*" else "." if c == "?" else f"\\{c}" if not c.isalnum() else c for c in pattern) + "$"


def discover(spark: SparkSession, root: str, exclude: tuple[str, ...] = EXCLUDED) -> DataFrame:
    """(file, text, sha256, size_bytes) of every .sql file below root; undecodable bytes fall back to Latin-1. Files of no bytes, for which the scan has no row, come from the folder's listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.sql").load(root)
    base = re.sub(r"^\w+:/*", "/", root).rstrip("/") + "/"
    file = F.col("path").substr(F.locate(base, F.col("path")) + len(base), F.length("path"))
    utf8 = F.expr("try_validate_utf8(CAST(content AS STRING))")
    rows = files.select(file.alias("file"), F.coalesce(utf8, F.decode("content", "ISO-8859-1")).alias("text"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size_bytes"))
    none = [(p, "", sha256(b"").hexdigest(), 0) for p in _empty_files(spark, root)]
    if none:
        rows = rows.unionByName(spark.createDataFrame(none, "file string, text string, sha256 string, size_bytes long"))
    return rows.filter(~excluded(F.col("file"), exclude))


def _empty_files(spark: SparkSession, root: str) -> list[str]:
    """Paths below root of .sql files of no bytes."""
    sc = spark.sparkContext
    top = sc._jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(top) or fs.getFileStatus(top).isFile():
        return []
    top, out, files = fs.getFileStatus(top).getPath().toString().rstrip("/"), [], fs.listFiles(top, True)
    while files.hasNext():
        f = files.next()
        if f.getLen() == 0 and f.getPath().getName().endswith(".sql"):
            out.append(f.getPath().toString()[len(top) + 1 :])
    return out


def excluded(file: Column, patterns: tuple[str, ...] = EXCLUDED) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | file.rlike(_glob(p))
    return out


def slug(file: Column) -> Column:
    """The stem in capitals, other characters as single underscores."""
    stem = F.regexp_replace(F.element_at(F.split(file, "/"), -1), r"\.[^.]*$", "")
    return F.upper(F.regexp_replace(stem, "[^A-Za-z0-9]+", "_"))


def file_id(file: Column) -> Column:
    return F.concat(slug(file), F.lit("__"), F.upper(F.substring(F.sha2(file, 256), 1, 8)))


def line_counts(text: Column) -> Column:
    """total, code, comment and blank lines; a block comment's state is carried along the lines of one text."""
    lines = F.split(F.regexp_replace(text, r"\r?\n\z", ""), r"\r?\n")
    lines = F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(lines)
    zero = F.struct(F.lit(0).alias("code"), F.lit(0).alias("comment"), F.lit(0).alias("blank"), F.lit(False).alias("open"))

    def step(a: Column, line: Column) -> Column:
        t = F.trim(line)
        blank = (t == "") & ~a["open"]
        comment = a["open"] | t.startswith("--") | t.startswith("/*")
        open_ = F.when(a["open"], ~t.contains("*/")).otherwise(t.startswith("/*") & ~t.contains("*/"))
        one = lambda c: F.when(c, 1).otherwise(0)
        return F.struct((a["code"] + one(~blank & ~comment)).alias("code"), (a["comment"] + one(~blank & comment)).alias("comment"), (a["blank"] + one(blank)).alias("blank"), open_.alias("open"))

    return F.aggregate(lines, zero, step, lambda a: F.struct((a["code"] + a["comment"] + a["blank"]).alias("total_lines"), a["code"].alias("code_lines"), a["comment"].alias("comment_lines"), a["blank"].alias("blank_lines")))


#: A word that a text must hold for a signal; texts without it aren't searched with the signal's pattern.
_NEEDED = {
    "has_create_table": "table", "has_create_view": "view", "has_create_index": "index", "has_create_sequence": "sequence", "has_create_synonym": "synonym", "has_grant": "grant", "has_package": "package", "has_procedure": "procedure",
    "has_function": "function", "has_trigger": "trigger", "has_insert": "insert", "has_dynamic_sql": "execute", "has_dbms_calls": "dbms_", "has_commit": "commit", "has_exception_block": "exception", "has_cursor": "cursor", "has_db_link": "@",
    "is_wrapped": "wrapped", "has_alter_table": "alter", "has_merge": "merge", "has_bulk_collect": "bulk", "has_forall": "forall", "has_autonomous_transaction": "pragma", "has_pipelined": "pipelined", "has_hierarchical_query": "connect",
}


def content_hints(text: Column) -> Column:
    """The signals that hold; the others are left out. A text is put in lower case once."""

    def of(low: Column) -> Column:
        pairs = [x for name, pattern in SIGNALS.items() for x in (F.lit(name), F.when(low.contains(_NEEDED[name]), low.rlike(pattern)).otherwise(False))]
        return F.map_filter(F.create_map(*pairs), lambda _, v: v)

    return F.element_at(F.transform(F.array(F.lower(text)), of), 1)


def file_role(hints: Column, file: Column) -> Column:
    """Content first; a migration's file name decides only among the rest."""
    has = lambda name: F.coalesce(hints[name], F.lit(False))
    routine = has("has_procedure") | has("has_function")
    schema = has("has_create_table") | has("has_create_sequence") | has("has_create_index")
    loose = has("has_create_view") | has("has_create_synonym") | has("has_grant")
    return (
        F.when(file.rlike(r"(^|/)V\d+__"), "migration")
        .when(has("has_package"), "package")
        .when(schema & loose, "mixed")
        .when(has("has_create_table"), "schema_ddl")
        .when(has("has_trigger"), "trigger")
        .when(has("has_procedure"), "procedure")
        .when(has("has_function"), "function")
        .when(has("has_insert") & ~routine, "seed_data")
        .when(schema, "schema_ddl")
        .when(loose, "mixed")
        .otherwise("unknown")
    )


def complexity(hints: Column) -> Column:
    has = lambda name: F.coalesce(hints[name], F.lit(False))
    return F.when(has("has_dynamic_sql") & has("has_dbms_calls"), "high").when(has("has_cursor") | has("has_exception_block") | has("has_dynamic_sql"), "medium").otherwise("low")


#: Roles whose files define the data model, and signals that make a file of another role one of them too.
DDL_ROLES = ("schema_ddl", "migration", "mixed")
DDL_SIGNALS = ("has_create_table", "has_create_view", "has_create_index", "has_create_sequence", "has_create_synonym", "has_alter_table")


def distinct_ids(rows: DataFrame, id_column: str, file: str, *within: str) -> DataFrame:
    """rows with ids told apart: of files whose path prints agree all but the first by path get a number, from 2."""
    n = F.row_number().over(Window.partitionBy(*within, id_column).orderBy(file))
    return rows.withColumn("_n", n).withColumn(id_column, F.when(F.col("_n") == 1, F.col(id_column)).otherwise(F.concat(id_column, F.lit("_"), F.col("_n").cast("string")))).drop("_n")


def route_ddl(inventory_: DataFrame) -> DataFrame:
    """inventory rows with `is_ddl`: by role or by what the text holds."""
    held = F.exists(F.map_keys("content_hints"), lambda k: k.isin(*DDL_SIGNALS))
    return inventory_.withColumn("is_ddl", F.col("file_role").isin(*DDL_ROLES) | held)


def feature_counts(inventory_: DataFrame) -> DataFrame:
    """(feature, files): how many files hold each signal."""
    return inventory_.select(F.explode(F.map_keys("content_hints")).alias("feature")).groupBy("feature").agg(F.count(F.lit(1)).alias("files"))


def high_complexity(inventory_: DataFrame) -> DataFrame:
    return inventory_.filter("complexity = 'high'").select("file")


def inventory(files: DataFrame) -> DataFrame:
    """One row for each file: identity, counts, signals, role, complexity and where it is parsed."""
    rows = files.select("file", file_id(F.col("file")).alias("file_id"), F.sha2("text", 256).alias("sha256"), line_counts(F.col("text")).alias("line_counts"), content_hints(F.col("text")).alias("content_hints"))
    rows = rows.withColumn("file_role", file_role(F.col("content_hints"), F.col("file"))).withColumn("complexity", complexity(F.col("content_hints")))
    parsed = F.col("file_role").isin("package", "procedure", "function", "trigger", "mixed")
    rows = distinct_ids(rows, "file_id", "file")
    return rows.withColumn("route", F.when(parsed, "parse").otherwise("pass"))


def summary(inventory_: DataFrame) -> DataFrame:
    """Files and lines by role and complexity."""
    return inventory_.groupBy("file_role", "complexity").agg(F.count(F.lit(1)).alias("files"), F.sum("line_counts.total_lines").alias("lines"), F.sum("line_counts.code_lines").alias("code_lines"))
