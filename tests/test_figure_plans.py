"""Figures of all objects in few shuffles: edges join nothing, lines are checked in one pass."""

from test_flow_edges import SOURCE

from quarrylens.plans import diagrams as dg, figure_check, rules as ru
from quarrylens.plans.code import Code


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _code(spark, text=SOURCE):
    return Code(spark.createDataFrame([("k.sql", text)], "file string, text string"))


def test_edges_need_no_join(spark):
    code = _code(spark)
    flows = dg.flows(code, ru.rules(code))
    assert "Join" not in plan_of(flows.edges) and "Exchange" not in plan_of(flows.edges)


def test_texts_are_made_once_for_their_check(spark):
    """figure_faults: one shuffle that makes the texts serves all faults."""
    code = _code(spark)
    texts = dg.flow_text(dg.flows(code, ru.rules(code)))
    plan = plan_of(figure_check.faults(texts, ["file_id", "object_id"]))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_faults_of_a_figure_without_a_key(spark):
    texts = spark.createDataFrame([(None, 'flowchart TD\n    n1["a"]\n    n1 --> n1')], "k string, mermaid string")
    assert figure_check.faults(texts, ["k"]).count() == 0


def test_rules_of_a_condition_that_reads_nothing(spark):
    """Its ELSE has no first name; this ended the job before."""
    code = _code(spark, "CREATE OR REPLACE PROCEDURE p IS\nBEGIN\n  IF 1 = 1 THEN\n    NULL;\n  ELSE\n    NULL;\n  END IF;\nEND p;\n/")
    assert sorted((r.line, r.condition) for r in ru.mined(code).collect()) == [(3, "1 = 1"), (5, None)]
