"""What grows with the input isn't sent through the driver, however small its files make Spark think it is."""

from quarrylens.plans import code as c, diagrams as dg, graph as gr, rules as ru, schema as sc
from quarrylens.plans.code import Code

ROUTINE = """CREATE PROCEDURE app.p IS
BEGIN
  FOR i IN 1 .. 3 LOOP
    BEGIN
      IF i > 1 THEN
        CASE i WHEN 2 THEN INSERT INTO t (a) VALUES (1); ELSE NULL; END CASE;
      END IF;
    EXCEPTION WHEN OTHERS THEN UPDATE t SET a = 2;
    END;
  END LOOP;
  q(1);
END p;
/
CREATE PROCEDURE app.q IS BEGIN p; EXCEPTION WHEN OTHERS THEN ROLLBACK; END q;
/
"""


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_guessed_side_is_broadcast(spark):
    code = Code(spark.createDataFrame([("a.sql", ROUTINE), ("b.sql", "CREATE TABLE t (a NUMBER(9));")], "file string, text string"))
    graph = gr.build(code)
    calls, rules = c._calls(code), ru._mined(code)
    found = {"calls": calls, "mined": rules, "complexity": c.complexity(code), "narrative": c.narrative(code), "violations": gr.violations(graph), "impact": gr.ask(graph, "What breaks if I change t.a?")["answer"]}
    assert [name for name, df in found.items() if "BroadcastHashJoin" in plan_of(df)] == []
    assert gr.violations(graph).count() == 0 and found["impact"].count() > 0


def test_nesting_needs_no_join(spark):
    code = Code(spark.createDataFrame([("a.sql", ROUTINE)], "file string, text string"))
    rows = c._nesting(code)
    assert "Join" not in plan_of(rows) and "Exchange" not in plan_of(rows) and "nesting*" not in code._rows
    s = {(r.object_id, r.seq): r for r in rows.collect()}
    assert len(s) > 8
    for r in s.values():
        above = [s[r.object_id, a].type for a in r.ancestors]
        assert (r.nesting, r.in_loop, r.in_handler) == (sum(t in c.NESTING for t in above), "LOOP" in above, "EXCEPTION_HANDLER" in above)


def test_no_side_found_by_name_is_broadcast(spark):
    code = Code(spark.createDataFrame([("a.sql", ROUTINE), ("b.sql", "CREATE TABLE t (a NUMBER(9));")], "file string, text string"))
    found = {"access": sc.table_access(code), "columns": sc._column_access(code), "unknown": sc.unknown_tables(code), "sequences": sc.sequence_usages(code), "moves": dg.transitions(code)}
    assert [name for name, df in found.items() if "BroadcastHashJoin" in plan_of(df)] == []
    assert {r.name for r in found["columns"].collect()} == {"A"} and found["unknown"].count() == 0
