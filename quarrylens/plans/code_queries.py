"""The code base analyses over routines and tables written, one for each row, from the driver's tables.

What a routine holds follows from its key, so SQL can say what every analysis must find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import language as la
from . import code as c, diagrams as dg, document as do, rules as ru, schema as sc
from .code import Code

_ROUTINE = """concat_ws('\\n',
  concat('CREATE OR REPLACE PROCEDURE app.p_', c_custkey, ' (p_id IN NUMBER, p_out OUT NUMBER) IS'), '  v_n NUMBER; -- IF COMMIT', 'BEGIN',
  '  SELECT balance INTO v_n FROM accounts WHERE id = p_id;', concat('  IF v_n > ', c_custkey, ' AND v_n < 9 THEN'), '    UPDATE accounts SET balance = v_n - 1 WHERE id = p_id;',
  IF(c_custkey % 2 = 0, '  ELSIF v_n = 0 THEN\\n    DELETE FROM audit WHERE id = p_id;', NULL), '  ELSE', '    p_out := ROUND(v_n * 2 / 3, 2);', '  END IF;',
  IF(c_custkey % 3 = 0, concat('  FOR i IN 1 .. 3 LOOP\\n    INSERT INTO audit (id) VALUES (p_id);\\n', IF(c_custkey % 6 = 0, '    COMMIT;\\n', ''), '  END LOOP;'), NULL),
  concat('  p_', c_custkey + 1, '(p_id, p_out);'), IF(c_custkey % 5 = 0, '  COMMIT;', NULL), 'EXCEPTION', '  WHEN NO_DATA_FOUND THEN', '    p_out := NULL;',
  IF(c_custkey % 7 = 0, '  WHEN OTHERS THEN\\n    ROLLBACK;\\n    RAISE;', NULL), concat('END p_', c_custkey, ';'), '/')"""
_TABLE = """concat_ws('\\n', concat('CREATE TABLE t_', s_suppkey, ' ('), concat('  id_', s_suppkey, ' NUMBER(9) NOT NULL,'), concat('  id_', s_suppkey + 1, ' NUMBER(9),'), '  status VARCHAR2(10) DEFAULT ''A'',', concat('  CONSTRAINT pk_', s_suppkey, ' PRIMARY KEY (id_', s_suppkey, '),'),
  concat('  CONSTRAINT ck_', s_suppkey, ' CHECK (status IN (''A'', ''B''))', CASE s_suppkey % 3 WHEN 0 THEN ' DISABLE' WHEN 1 THEN ' ENABLE NOVALIDATE' ELSE '' END), ');')"""


_KEPT: dict[tuple[str, str, str], Code] = {}


def _kept(spark, sf_dir: str, kind: str, make) -> Code:
    """A code base read once for an application; its facts and shared analyses are written tables."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def _routines(spark, sf_dir: str) -> Code:
    return _kept(spark, sf_dir, "routines", lambda: Code(spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.expr("concat('r/', c_custkey, '.sql')").alias("file"), F.expr(_ROUTINE).alias("text"))))


def _tables(spark, sf_dir: str) -> Code:
    return _kept(spark, sf_dir, "tables", lambda: Code(spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.expr("concat('t/', s_suppkey, '.sql')").alias("file"), F.expr(_TABLE).alias("text"))))


def code_complexity(spark, sf_dir: str) -> DataFrame:
    return c.complexity(_routines(spark, sf_dir)).select("object_id", *[F.col(x).cast("long").alias(x) for x in ("n_statements", "cyclomatic", "cognitive")])


def code_crud(spark, sf_dir: str) -> DataFrame:
    return c.crud(_routines(spark, sf_dir)).select("object_id", "table_name", "crud")


def code_calls(spark, sf_dir: str) -> DataFrame:
    return c.calls(_routines(spark, sf_dir)).select("object_id", "call_target", "call_target_object_id", "status")


def code_flow(spark, sf_dir: str) -> DataFrame:
    return c.control_flow(_routines(spark, sf_dir)).groupBy("object_id", "type").agg(F.count(F.lit(1)).alias("edges"))


def code_transactions(spark, sf_dir: str) -> DataFrame:
    return c.transactions(_routines(spark, sf_dir)).select("object_id", "commits", "commit_inside_loop", "is_atomic")


def code_shapes(spark, sf_dir: str) -> DataFrame:
    return c.shapes(_routines(spark, sf_dir)).select("object_id", "shape", "dml_inside_loop")


def code_slices(spark, sf_dir: str) -> DataFrame:
    return c.slices(_routines(spark, sf_dir)).select("object_id", "variable", F.size("determined_by").cast("long").alias("statements"), F.array_join("depends_on_variables", ",").alias("depends_on"))


def code_rules(spark, sf_dir: str) -> DataFrame:
    return ru.deduplicate(ru.mined(_routines(spark, sf_dir))).groupBy("object_id", "kind").agg(F.count(F.lit(1)).alias("rules"))


def schema_enforcement(spark, sf_dir: str) -> DataFrame:
    return sc.constraints(_tables(spark, sf_dir)).filter("kind = 'CHECK'").select("name", "status", "validated", "explicitly_stated", "is_enforced", "confidence", F.col("signal_strength").cast("long").alias("signal_strength"))


def schema_inferred(spark, sf_dir: str) -> DataFrame:
    return sc.inferred_relationships(_tables(spark, sf_dir)).select("from_table", "from_column", "to_table")


def schema_columns(spark, sf_dir: str) -> DataFrame:
    return sc.columns(_tables(spark, sf_dir)).select("table_name", "name", "pyspark_type", "nullable", F.array_join("enum_values", ",").alias("enum_values"), "enum_confidence")


def _flows(spark, sf_dir: str, budget: int) -> dg.Flows:
    code = _routines(spark, sf_dir)
    return dg.flows(code, ru.deduplicate(ru.mined(code)).withColumn("rule_id", F.concat(F.lit("BR-"), "raw_key")), budget)


def code_figures(spark, sf_dir: str) -> DataFrame:
    return _flows(spark, sf_dir, 12).report.select("object_id", F.col("nodes").cast("long").alias("nodes"), F.col("statements").cast("long").alias("statements"))


def code_branches(spark, sf_dir: str) -> DataFrame:
    f = _flows(spark, sf_dir, dg.NODE_BUDGET)
    return f.edges.filter("type IN ('BRANCH', 'LOOP_ENTRY', 'LOOP_BACK', 'EXCEPTION')").groupBy("object_id", "type").agg(F.count(F.lit(1)).alias("edges"), F.count("rule_id").alias("with_rule"))


def code_glossary(spark, sf_dir: str) -> DataFrame:
    return do.glossary(_routines(spark, sf_dir)).select("term", "kind", F.array_join("technical_names", ",").alias("technical_names"))


def code_capabilities(spark, sf_dir: str) -> DataFrame:
    code = _routines(spark, sf_dir)
    return do.capabilities(code, ru.deduplicate(ru.mined(code))).select("object_id", "title", "shape", "transaction", F.array_join("loops", ",").alias("loops"), "rules")


def schema_states(spark, sf_dir: str) -> DataFrame:
    return dg.states(_tables(spark, sf_dir))


def condition_words(spark, sf_dir: str) -> DataFrame:
    said = F.concat(F.lit("(v_acct_bal <= p_"), F.lower("c_mktsegment"), F.lit(") OR rec.txn_status = 'P_"), "c_custkey", F.lit("'"))
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", la.humanise_condition(said).alias("words"), la.short_condition(F.concat(F.lit("(p_amt > NVL(v_x, "), "c_custkey", F.lit("))"))).alias("short"))


def type_words(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", la.plain_type(F.concat(F.lit("NUMBER("), "p_size", F.lit(","), F.col("p_partkey") % 3, F.lit(")"))).alias("words"))


_ALL = (code_figures, code_branches, code_glossary, code_capabilities, schema_states, condition_words, type_words, code_complexity, code_crud, code_calls, code_flow, code_transactions, code_shapes, code_slices, code_rules, schema_enforcement, schema_inferred, schema_columns)


def queries():
    return {f.__name__: f for f in _ALL}


def oracle_sql():
    k = "SELECT c_custkey AS k, 'PROC-APP.P_' || c_custkey AS object_id, CAST(c_custkey % 2 = 0 AS BIGINT) AS e, CAST(c_custkey % 3 = 0 AS BIGINT) AS l, CAST(c_custkey % 6 = 0 AS BIGINT) AS lc, CAST(c_custkey % 5 = 0 AS BIGINT) AS m, CAST(c_custkey % 7 = 0 AS BIGINT) AS o FROM customer"
    return {
        "code_figures": f"SELECT object_id, statements + 2 - CASE WHEN statements + 2 > 12 THEN lc + m ELSE 0 END AS nodes, statements FROM (SELECT *, 7 + e + 2 * l + lc + m + 3 * o AS statements FROM ({k}))",
        "code_branches": f"SELECT * FROM (SELECT object_id, 'BRANCH' AS type, 2 + e AS edges, 2 + e AS with_rule FROM ({k}) UNION ALL SELECT object_id, 'LOOP_ENTRY', l, CAST(0 AS BIGINT) FROM ({k}) UNION ALL SELECT object_id, 'LOOP_BACK', l, 0 FROM ({k}) UNION ALL SELECT object_id, 'EXCEPTION', 2 + 2 * o, 0 FROM ({k})) WHERE edges > 0",
        "code_glossary": f"SELECT 'P ' || k AS term, 'program unit' AS kind, object_id AS technical_names FROM ({k})",
        "code_capabilities": f"SELECT object_id, 'P ' || k AS title, CASE WHEN l = 1 THEN 'Batch job that changes records one after another' ELSE 'Single business transaction' END AS shape, CASE WHEN lc + m = 0 THEN 'left to the caller' WHEN lc > 0 THEN 'each turn of the loop is made lasting on its own' ELSE 'all or nothing' END AS transaction, CASE WHEN l = 1 THEN 'once for each item of a known set' ELSE '' END AS loops, 4 + e AS rules FROM ({k})",
        "schema_states": "SELECT 'T_' || s_suppkey AS table_name, 'STATUS' AS name, unnest(['A', 'B']) AS state FROM supplier",
        "condition_words": "SELECT c_custkey, '(Account Balance is at most ' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ') or Transaction Status is ''P_' || c_custkey || '''' AS words, 'amt > NVL(x, ' || c_custkey || ')' AS short FROM customer",
        "type_words": "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'Whole number (' || p_size || ' digits)' ELSE 'Decimal number (' || p_size || ' digits, ' || (p_partkey % 3) || ' decimal places)' END AS words FROM part",
        "code_complexity": f"SELECT object_id, 7 + e + 2 * l + lc + m + 3 * o AS n_statements, 4 + e + l + o AS cyclomatic, 4 + l + o + e AS cognitive FROM ({k})",
        "code_crud": f"SELECT object_id, 'ACCOUNTS' AS table_name, 'RU' AS crud FROM ({k}) UNION ALL SELECT object_id, 'AUDIT', CASE WHEN l = 1 THEN 'C' ELSE '' END || CASE WHEN e = 1 THEN 'D' ELSE '' END FROM ({k}) WHERE l + e > 0",
        "code_calls": f"SELECT object_id, 'P_' || (k + 1) AS call_target, CASE WHEN k + 1 IN (SELECT c_custkey FROM customer) THEN 'PROC-APP.P_' || (k + 1) END AS call_target_object_id, CASE WHEN k + 1 IN (SELECT c_custkey FROM customer) THEN 'resolved' ELSE 'unresolved_reference' END AS status FROM ({k})",
        "code_flow": f"SELECT * FROM (SELECT object_id, 'SEQUENCE' AS type, 2 + l + lc + m + o AS edges FROM ({k}) UNION ALL SELECT object_id, 'BRANCH_ENTRY', 3 + e + l + o FROM ({k}) UNION ALL SELECT object_id, 'EXCEPTION_EDGE', 1 + o FROM ({k}) UNION ALL SELECT object_id, 'LOOP_BACK_EDGE', l FROM ({k})) WHERE edges > 0",
        "code_transactions": f"SELECT object_id, CAST(lc + m AS INTEGER) AS commits, CAST(lc AS INTEGER) AS commit_inside_loop, lc = 0 AS is_atomic FROM ({k})",
        "code_shapes": f"SELECT object_id, CASE WHEN l = 1 THEN 'BATCH_PROCESSOR' ELSE 'SINGLE_RECORD_TRANSACTION' END AS shape, l = 1 AS dml_inside_loop FROM ({k})",
        "code_slices": f"SELECT object_id, 'V_N' AS variable, CAST(1 AS BIGINT) AS statements, 'P_ID' AS depends_on FROM ({k}) UNION ALL SELECT object_id, 'P_OUT', CAST(5 AS BIGINT), 'P_ID,V_N' FROM ({k}) UNION ALL SELECT object_id, 'I', CAST(1 AS BIGINT), '' FROM ({k}) WHERE l = 1",
        "code_rules": f"SELECT object_id, 'conditional_branch' AS kind, 2 + e AS rules FROM ({k}) UNION ALL SELECT object_id, 'predefined_exception', CAST(1 AS BIGINT) FROM ({k}) UNION ALL SELECT object_id, 'variable_derivation', CAST(1 AS BIGINT) FROM ({k})",
        "schema_enforcement": "SELECT 'CK_' || s_suppkey AS name, CASE WHEN s_suppkey % 3 = 0 THEN 'DISABLED' ELSE 'ENABLED' END AS status, CASE WHEN s_suppkey % 3 = 2 THEN 'VALIDATED' ELSE 'NOT_VALIDATED' END AS validated, s_suppkey % 3 <> 2 AS explicitly_stated, s_suppkey % 3 <> 0 AS is_enforced, ['not_enforced', 'enforced_new_data_only', 'enforced'][s_suppkey % 3 + 1] AS confidence, CAST([2, 4, 5][s_suppkey % 3 + 1] AS BIGINT) AS signal_strength FROM supplier",
        "schema_inferred": "SELECT 'T_' || a.s_suppkey AS from_table, 'ID_' || b.s_suppkey AS from_column, 'T_' || b.s_suppkey AS to_table FROM supplier a JOIN supplier b ON b.s_suppkey = a.s_suppkey + 1",
        "schema_columns": "SELECT 'T_' || s_suppkey AS table_name, 'ID_' || s_suppkey AS name, 'DecimalType(9,0)' AS pyspark_type, FALSE AS nullable, CAST(NULL AS VARCHAR) AS enum_values, CAST(NULL AS VARCHAR) AS enum_confidence FROM supplier UNION ALL SELECT 'T_' || s_suppkey, 'ID_' || (s_suppkey + 1), 'DecimalType(9,0)', TRUE, NULL, NULL FROM supplier UNION ALL SELECT 'T_' || s_suppkey, 'STATUS', 'StringType', TRUE, 'A,B', ['not_enforced', 'enforced_new_data_only', 'enforced'][s_suppkey % 3 + 1] FROM supplier",
    }
