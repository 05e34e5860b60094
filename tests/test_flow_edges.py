"""Edges of the control flow from the statements' own rows, against the siblings looked up one by one; nothing is shuffled for them."""

from quarrylens.plans.code import Code, control_flow
from quarrylens.sources.lexer import tokens_of

SOURCE = """CREATE OR REPLACE PACKAGE BODY app.k IS
  PROCEDURE a(p_a IN NUMBER) IS
  BEGIN
    IF p_a > 0 THEN
      v := 1; /* a comment
      of two lines */ UPDATE t SET x = 'it''s
 two' WHERE y = p_a;
    ELSIF p_a = 0 THEN
      RAISE e_zero;
    ELSE
      FOR r IN 1 .. 3 LOOP
        BEGIN
          INSERT INTO t (x) VALUES (r);
          CASE r WHEN 1 THEN NULL; ELSE v := 2; v := 3; END CASE;
        EXCEPTION
          WHEN NO_DATA_FOUND OR OTHERS THEN
            NULL;
            RAISE;
        END;
      END LOOP;
    END IF;
    COMMIT;
  EXCEPTION
    WHEN OTHERS THEN
      ROLLBACK;
  END a;
  PROCEDURE b IS BEGIN WHILE TRUE LOOP NULL; EXIT; END LOOP; END b;
END k;
/"""


def edges_of(rows):
    """Source, target, type of every edge, each statement's siblings looked up among all."""
    out = set()
    main = [r for r in rows if r.type != "EXCEPTION_HANDLER"]
    at = {(r.object_id, r.seq): r.statement_id for r in rows}
    for r in rows:
        if r.type == "EXCEPTION_HANDLER":
            out.add(("*", r.statement_id, "EXCEPTION_EDGE"))
            continue
        inside = sorted(x.seq for x in main if (x.object_id, x.parent, x.scope) == (r.object_id, r.parent, r.scope))
        k = inside.index(r.seq)
        if k + 1 < len(inside):
            out.add((r.statement_id, at[r.object_id, inside[k + 1]], "SEQUENCE"))
        elif r.scope.startswith("LOOP"):
            out.add((r.statement_id, at[r.object_id, r.parent], "LOOP_BACK_EDGE"))
        if k == 0 and r.parent is not None:
            out.add((at[r.object_id, r.parent], r.statement_id, "BRANCH_ENTRY"))
    return out


def test_edges_without_a_shuffle(spark):
    code = Code(spark.createDataFrame([("k.sql", SOURCE)], "file string, text string"))
    rows, flow = code.rows("statements").collect(), control_flow(code)
    found = [(e.source, e.target, e.type) for e in flow.collect()]
    assert len(found) == len(set(found)) and set(found) == edges_of(rows)
    assert {e.branch for e in flow.filter("type = 'BRANCH_ENTRY'").collect()} == {"true", "elsif", "false", "loop body", "block", "WHEN(1)", "WHEN(NO_DATA_FOUND_OTHERS)", "WHEN(OTHERS)"}
    plan = flow._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_arms_know_what_they_hold(spark):
    arms = {(a.kind, a.arm): a for a in Code(spark.createDataFrame([("k.sql", SOURCE)], "file string, text string")).rows("arms").collect()}
    assert [k for k, a in arms.items() if a.refuses] == [("IF", "ELSIF1")]
    assert arms["IF", "ELSE"]["of"] == "P_A" and arms["CASE", "WHEN1"]["of"] == "R"


def test_lines_over_many_rows():
    assert [(t.text, t.line) for t in tokens_of("a /* b\n c */ d\n'e\nf' g\n\"h\ni\" j -- 'k\nl")] == [("A", 1), ("D", 2), ("'e\nf'", 3), ("G", 4), ("h\ni", 5), ("J", 6), ("L", 7)]
