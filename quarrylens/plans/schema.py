"""The data model of a code base as relations: columns, enforcement, value lists, relationships, catalogue, rule candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import oracle
from .code import Code
from .cut import big

_NUMBERS = ("NUMBER", "DECIMAL", "DEC", "NUMERIC")
#: Fixed value: the form of a listed value in a comment.
_ENUM_TOKEN = "^[A-Z][A-Z0-9_]*$"
_IN_LIST = r"(?is)^\s*\w+\s+IN\s*\("


def type_family(declared: Column) -> Column:
    """DECIMAL, STRING, DATETIME, TIMESTAMP, INTEGER, FLOAT, DOUBLE, BINARY or UNKNOWN."""
    name = F.trim(F.regexp_extract(F.upper(declared), r"^([A-Z_0-9]+(?: PRECISION)?)", 1))
    return (
        F.when(name.isin(*_NUMBERS), "DECIMAL").when(name.isin(*oracle._INTEGERS), "INTEGER").when(name == "DATE", "DATETIME").when(name.startswith("TIMESTAMP"), "TIMESTAMP").when(name.isin("BINARY_FLOAT", "REAL"), "FLOAT")
        .when(name.isin("BINARY_DOUBLE", "DOUBLE PRECISION", "FLOAT"), "DOUBLE").when(name.isin(*oracle._BINARY), "BINARY").when(name.isin(*oracle._TEXTS), "STRING").otherwise("UNKNOWN")
    )


def spark_type(declared: Column) -> Column:
    family, p, s = type_family(declared), F.regexp_extract(declared, r"\((\d+)", 1), F.regexp_extract(declared, r",\s*(-?\d+)", 1)
    decimal = F.when(p == "", "DecimalType(38,10)").otherwise(F.concat(F.lit("DecimalType("), p, F.lit(","), F.when(s == "", "0").otherwise(s), F.lit(")")))
    names = {"INTEGER": "IntegerType", "DATETIME": "TimestampType", "TIMESTAMP": "TimestampType", "FLOAT": "FloatType", "DOUBLE": "DoubleType", "BINARY": "BinaryType"}
    out = F.when(family == "DECIMAL", decimal)
    for k, v in names.items():
        out = out.when(family == k, v)
    return out.otherwise("StringType")


def enforcement(constraints: DataFrame) -> DataFrame:
    """Each constraint with whether it holds, how far, whether it may become a rule, and its weight as one."""
    on, checked = F.col("status") == "ENABLED", F.col("validated") == "VALIDATED"
    return constraints.select(
        "*", on.alias("is_enforced"), F.when(~on, "not_enforced").when(checked, "enforced").otherwise("enforced_new_data_only").alias("confidence"), on.alias("promotable_to_rule"),
        F.when(~on, 2).when(checked, 5).otherwise(4).alias("signal_strength"), F.when(~on, "low").when(checked, "confirmed").otherwise("high").alias("rule_confidence"), (~(on & checked)).alias("requires_sme_review"),
    )


def constraints(code: Code) -> DataFrame:
    return enforcement(code.rows("constraints"))


def primary_keys(code: Code) -> DataFrame:
    return code.rows("constraints").filter("kind = 'PRIMARY KEY'").select("table_name", F.col("columns").alias("primary_key"))


def columns(code: Code) -> DataFrame:
    return code.once("columns*", lambda: _columns(code))


def _columns(code: Code) -> DataFrame:
    """Each column with its types, comment, and the values it may take: from a CHECK with the constraint's confidence, else from a comment only."""
    listed = constraints(code).filter((F.col("kind") == "CHECK") & F.col("expression").rlike(_IN_LIST))
    listed = listed.groupBy("table_name", F.upper(F.col("columns")[0]).alias("name")).agg(F.min_by("confidence", F.struct(-F.col("signal_strength"), "line")).alias("c"), F.min_by(F.regexp_extract_all("expression", F.lit("'([^']*)'"), 1), F.struct(-F.col("signal_strength"), "line")).alias("v"))
    notes = code.rows("comments").groupBy("table_name", F.col("column_name").alias("name")).agg(F.max("comment").alias("comment")).filter("name IS NOT NULL")
    said = F.filter(F.transform(F.split("remark", ","), lambda x: F.trim(x)), lambda x: x.rlike(_ENUM_TOKEN))
    all_said = (F.size(said) >= 2) & F.col("remark").isNotNull()
    rows = code.rows("columns").join(big(listed), ["table_name", "name"], "left").join(big(notes), ["table_name", "name"], "left")
    return rows.select(
        "file_id", "table_name", "name", "position", "type", type_family(F.col("type")).alias("normalized_type"), spark_type(F.col("type")).alias("pyspark_type"), "nullable", "default", "is_virtual", "generation_expression", "is_identity", "identity_generation", "comment",
        F.when(F.col("v").isNotNull(), F.col("v")).when(all_said, said).alias("enum_values"), F.when(F.col("v").isNotNull(), "check_constraint").when(all_said, "comment_only").alias("enum_source"),
        F.when(F.col("v").isNotNull(), F.col("c")).when(all_said, "documented_only").alias("enum_confidence"), (F.col("v").isNull() & all_said).alias("requires_sme_review"), "line",
    )


def inferred_relationships(code: Code) -> DataFrame:
    """Undeclared references: a column named and typed like another table's single-column key, outside its own key."""
    cols = code.rows("columns").select("table_name", "name", type_family(F.col("type")).alias("family"))
    keys = primary_keys(code)
    single = keys.filter(F.size("primary_key") == 1).select(F.col("table_name").alias("to_table"), F.col("primary_key")[0].alias("name")).join(big(cols.select(F.col("table_name").alias("to_table"), "name", F.col("family").alias("to_family"))), ["to_table", "name"])
    own = keys.select("table_name", F.explode("primary_key").alias("name"))
    declared = code.rows("constraints").filter("kind = 'FOREIGN KEY'").select("table_name", F.explode("columns").alias("name"))
    found = cols.join(big(own), ["table_name", "name"], "left_anti").join(big(declared), ["table_name", "name"], "left_anti").join(big(single), "name").filter("table_name <> to_table AND family = to_family")
    return found.select(F.col("table_name").alias("from_table"), F.col("name").alias("from_column"), "to_table", F.lit("inferred").alias("relationship_type"), F.lit("medium").alias("confidence"), F.lit("name_match+type_compatible").alias("basis"))


def type_references(code: Code) -> DataFrame:
    """Each %TYPE and %ROWTYPE with whether the data model has what it names."""
    declared = code.rows("variables").select("file_id", "object_id", "type").unionByName(code.rows("parameters").select("file_id", "object_id", "type"))
    used = declared.filter(F.col("type").rlike(r"%(ROW)?TYPE")).withColumn("parts", F.split(F.regexp_extract("type", r"^([\w.$#]+)%", 1), r"\."))
    whole = F.col("type").contains("%ROWTYPE")
    used = used.withColumn("table_name", F.when(whole, F.element_at("parts", -1)).otherwise(F.try_element_at("parts", F.lit(-2)))).withColumn("name", F.when(~whole, F.element_at("parts", -1)))
    known = code.rows("columns").select("table_name", "name").unionByName(code.rows("tables").select("table_name", F.lit(None).cast("string").alias("name"))).distinct().withColumn("resolved", F.lit(True))
    found = used.alias("u").join(big(known.alias("k")), F.expr("u.table_name = k.table_name AND u.name <=> k.name"), "left")
    return found.select("u.file_id", "u.object_id", F.col("u.type").alias("reference"), F.coalesce("k.resolved", F.lit(False)).alias("resolved"))


def sequence_usages(code: Code) -> DataFrame:
    used = code.rows("statements").select("statement_id", "file_id", "object_id", "line", F.explode(F.expr(r"regexp_extract_all(upper(text), '(\\w+)\\s*\\.\\s*NEXTVAL', 1)")).alias("sequence_name"))
    return used.join(big(code.rows("sequences").select("sequence_name", F.lit(True).alias("declared")).distinct()), "sequence_name", "left").fillna({"declared": False})


def table_access(code: Code) -> DataFrame:
    """(statement, table, crud) with synonyms replaced by what they stand for and views by the tables they read."""
    used = code.rows("statements").select("statement_id", "file_id", "object_id", "line", F.explode("access").alias("a")).select("statement_id", "file_id", "object_id", "line", F.upper("a.table_name").alias("t"), F.col("a.crud").alias("crud"))
    syn = code.rows("synonyms").groupBy(F.col("synonym_name").alias("t")).agg(F.max("target_object").alias("target"))
    views = code.rows("views").groupBy(F.col("view_name").alias("v")).agg(F.max("references_tables").alias("below"))
    named = used.join(big(syn), "t", "left").withColumn("v", F.coalesce("target", "t")).join(big(views), "v", "left")
    return named.select("statement_id", "file_id", "object_id", "line", F.explode(F.coalesce("below", F.array("v"))).alias("table_name"), "crud")


def unknown_tables(code: Code) -> DataFrame:
    return table_access(code).join(big(code.rows("tables").select("table_name")), "table_name", "left_anti")


def column_access(code: Code) -> DataFrame:
    return code.once("column_access*", lambda: _column_access(code))


def _column_access(code: Code) -> DataFrame:
    """(statement, table, column, mode): a column counts where its statement touches the table that has it."""
    s = code.rows("statements")
    parts = [s.select("statement_id", F.explode(F.transform(c, F.upper)).alias("name"), F.lit(m).alias("mode")) for c, m in (("reads", "READ"), ("writes", "WRITE"))]
    named = parts[0].unionByName(parts[1]).distinct()
    tables = table_access(code).select("statement_id", "file_id", "object_id", "line", "table_name", (F.col("crud") != "R").alias("changes")).groupBy("statement_id", "file_id", "object_id", "line", "table_name").agg(F.max("changes").alias("changes"))
    found = named.join(big(tables), "statement_id").filter("mode = 'READ' OR changes")
    return found.join(big(code.rows("columns").select("table_name", "name")), ["table_name", "name"])


def column_catalogue(code: Code) -> DataFrame:
    used = column_access(code).groupBy("table_name", "name").agg(F.count(F.lit(1)).alias("usage_count"), F.sort_array(F.collect_set("object_id")).alias("used_by_objects"))
    rows = columns(code).join(big(used), ["table_name", "name"], "left").fillna({"usage_count": 0})
    return rows.select(F.concat_ws(".", "table_name", "name").alias("column_id"), "table_name", "name", "pyspark_type", F.col("comment").alias("description"), "usage_count", F.coalesce("used_by_objects", F.array().cast("array<string>")).alias("used_by_objects"))


def rule_candidates(code: Code) -> DataFrame:
    """Five kinds of statements of a schema that state a rule; switched-off ones stay and say so."""
    shape = ["source_kind", "file_id", "table_name", "constraint_name", "expression", "columns", "is_enforced", "signal_strength", "rule_confidence", "requires_sme_review", "line"]
    own = constraints(code).filter("kind IN ('CHECK', 'UNIQUE')").select(F.when(F.col("kind") == "CHECK", "check_constraint").otherwise("unique_constraint").alias("source_kind"), "file_id", "table_name", F.col("name").alias("constraint_name"), F.coalesce("expression", F.array_join("columns", ", ")).alias("expression"), "columns", "is_enforced", "signal_strength", "rule_confidence", "requires_sme_review", "line")
    firm = [F.lit(True).alias("is_enforced"), F.lit(5).alias("signal_strength"), F.lit("confirmed").alias("rule_confidence"), F.lit(False).alias("requires_sme_review")]
    virtual = code.rows("columns").filter("is_virtual").select(F.lit("virtual_column").alias("source_kind"), "file_id", "table_name", F.lit(None).cast("string").alias("constraint_name"), F.col("generation_expression").alias("expression"), F.array("name").alias("columns"), *firm, "line")
    index = code.rows("indexes").filter("is_unique").select(F.lit("unique_index").alias("source_kind"), "file_id", "table_name", F.col("index_name").alias("constraint_name"), F.array_join("columns", ", ").alias("expression"), "columns", *firm, "line")
    view = code.rows("views").filter("filter_predicate IS NOT NULL").select(F.lit("view_filter").alias("source_kind"), "file_id", F.col("view_name").alias("table_name"), F.lit(None).cast("string").alias("constraint_name"), F.col("filter_predicate").alias("expression"), F.array().cast("array<string>").alias("columns"), *firm, "line")
    return own.unionByName(virtual).unionByName(index).unionByName(view).select(*shape)


def erd(code: Code) -> DataFrame:
    """(rank, table_name, line) of the diagram, which reads in that order: tables with columns, declared references solid with their delete action, inferred ones dotted."""
    cols = columns(code).groupBy("table_name").agg(F.sort_array(F.collect_list(F.struct("position", F.concat(F.lit("        "), F.regexp_extract("type", r"^\w+", 0), F.lit(" "), "name").alias("l")))).alias("c"))
    boxes = cols.select(F.lit(0).alias("rank"), "table_name", F.concat(F.lit("    "), "table_name", F.lit(" {\n"), F.array_join(F.transform("c", lambda x: x["l"]), "\n"), F.lit("\n    }")).alias("l"))
    action = F.when(F.col("on_delete") == "NO_ACTION", "").otherwise(F.concat(F.lit(" ["), "on_delete", F.lit("]")))
    solid = code.rows("constraints").filter("kind = 'FOREIGN KEY'").select(F.lit(1).alias("rank"), "table_name", F.concat(F.lit("    "), "references_table", F.lit(" ||--o{ "), "table_name", F.lit(' : "'), F.array_join("columns", ", "), action, F.lit('"')).alias("l"))
    dotted = inferred_relationships(code).select(F.lit(2).alias("rank"), F.col("from_table").alias("table_name"), F.concat(F.lit("    "), "to_table", F.lit(" ||..o{ "), "from_table", F.lit(' : "'), "from_column", F.lit(' (inferred)"')).alias("l"))
    head = code.facts.sparkSession.createDataFrame([(-1, "", "erDiagram")], "rank int, table_name string, l string")
    return head.unionByName(boxes).unionByName(solid).unionByName(dotted).withColumnRenamed("l", "line")
