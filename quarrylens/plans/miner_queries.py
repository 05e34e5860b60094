"""Rule miners over routines with cursors, cases, refusals and handlers, one routine for each row of `supplier`.

What a routine holds follows from its key: every one refuses small numbers; every second reads a cursor in a loop that goes on after a
failure; every third chooses by a CASE; every fifth turns any failure into one of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import code as c, rules as ru
from .code import Code
from .code_queries import _kept

_BATCH = """concat_ws('\\n', concat('CREATE OR REPLACE PROCEDURE app.q_', s_suppkey, ' (p_id IN NUMBER) IS'), '  v_r NUMBER;',
  IF(s_suppkey % 2 = 0, concat('  CURSOR c_due IS SELECT id, balance FROM accounts WHERE status = ''A'' AND balance > ', s_suppkey, ';'), NULL), 'BEGIN',
  concat('  IF p_id < ', s_suppkey, ' THEN'), '    RAISE_APPLICATION_ERROR(-20001, ''too small'');', '  END IF;',
  IF(s_suppkey % 3 = 0, '  CASE p_id\\n    WHEN 1 THEN\\n      v_r := 5;\\n    WHEN 2 THEN\\n      v_r := 6;\\n    ELSE\\n      v_r := 7;\\n  END CASE;', NULL),
  IF(s_suppkey % 2 = 0, concat_ws('\\n', '  FOR rec IN c_due LOOP', '    BEGIN', '      UPDATE accounts SET balance = balance - 1 WHERE id = rec.id;', '    EXCEPTION', '      WHEN OTHERS THEN',
    '        INSERT INTO audit (id) VALUES (rec.id);', '    END;', '  END LOOP;'), NULL),
  IF(s_suppkey % 5 = 0, concat_ws('\\n', 'EXCEPTION', '  WHEN OTHERS THEN', '    RAISE_APPLICATION_ERROR(-20002, ''failed'');'), NULL), concat('END q_', s_suppkey, ';'), '/')"""
_K = "SELECT s_suppkey AS k, 'PROC-APP.Q_' || s_suppkey AS object_id FROM supplier"


def _batches(spark, sf_dir: str) -> Code:
    return _kept(spark, sf_dir, "batches", lambda: Code(spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.expr("concat('q/', s_suppkey, '.sql')").alias("file"), F.expr(_BATCH).alias("text"))))


def miner_kinds(spark, sf_dir: str) -> DataFrame:
    """Rules of each kind after deduplication: a refusal takes the place of the branch that it stands in."""
    return ru.deduplicate(ru.mined(_batches(spark, sf_dir))).groupBy("object_id", "kind").agg(F.count(F.lit(1)).alias("rules"))


def miner_obligations(spark, sf_dir: str) -> DataFrame:
    """The refusals with their conditions."""
    return ru.deduplicate(ru.mined(_batches(spark, sf_dir))).filter("is_obligation").select("object_id", "condition", "signal_strength", "confidence")


def miner_cursors(spark, sf_dir: str) -> DataFrame:
    """What a cursor's rows must be."""
    return ru.mined(_batches(spark, sf_dir)).filter("kind = 'cursor_eligibility'").select("object_id", F.regexp_replace("condition", r"\s+", " ").alias("condition"))


def miner_errors(spark, sf_dir: str) -> DataFrame:
    """Handlers that state a rule: goes on after a failure, or turns it into one of its own."""
    return ru.mined(_batches(spark, sf_dir)).filter("kind IN ('failure_isolation', 'error_contract')").select("object_id", "kind")


def miner_flow(spark, sf_dir: str) -> DataFrame:
    """Complexity of routines with cases, loops and blocks of their own."""
    return c.complexity(_batches(spark, sf_dir)).select("object_id", F.col("cyclomatic").cast("long").alias("cyclomatic"))


_ALL = (miner_kinds, miner_obligations, miner_cursors, miner_errors, miner_flow)


def queries():
    return {f.__name__: f for f in _ALL}


def oracle_sql():
    return {
        "miner_kinds": f"""SELECT object_id, 'named_exception' AS kind, CAST(1 AS BIGINT) AS rules FROM ({_K}) UNION ALL SELECT object_id, 'case_branch', 3 FROM ({_K}) WHERE k % 3 = 0
UNION ALL SELECT object_id, 'cursor_eligibility', 1 FROM ({_K}) WHERE k % 2 = 0 UNION ALL SELECT object_id, 'failure_isolation', 1 FROM ({_K}) WHERE k % 2 = 0 UNION ALL SELECT object_id, 'error_contract', 1 FROM ({_K}) WHERE k % 5 = 0""",
        "miner_obligations": f"SELECT object_id, 'p_id < ' || k AS condition, CAST(4 AS INTEGER) AS signal_strength, 'high' AS confidence FROM ({_K})",
        "miner_cursors": f"SELECT object_id, 'status = ''A'' AND balance > ' || k AS condition FROM ({_K}) WHERE k % 2 = 0",
        "miner_errors": f"SELECT object_id, 'failure_isolation' AS kind FROM ({_K}) WHERE k % 2 = 0 UNION ALL SELECT object_id, 'error_contract' FROM ({_K}) WHERE k % 5 = 0",
        "miner_flow": f"SELECT object_id, CAST(2 + CASE WHEN k % 3 = 0 THEN 2 ELSE 0 END + CASE WHEN k % 2 = 0 THEN 2 ELSE 0 END + CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS BIGINT) AS cyclomatic FROM ({_K})",
    }
