"""Figures' texts read line by line: what is fit passes, each fault is named with its line, and a bad figure stops the stage."""

import pytest

from quarrylens.plans import diagrams as dg, figure_check, rules as ru
from quarrylens.plans.code import Code

FIT = 'flowchart TD\n    n1(["start"])\n    n2{"x #quot;a#quot; > 1?"}\n    n3[["fails"]]\n    n1 --> n2\n    n2 -->|"yes - BR-001"| n3\n    n3 -.-> n1'
STATES = "stateDiagram-v2\n    OPEN\n    CLOSED\n    [*] --> OPEN\n    OPEN --> CLOSED : inferred"
CASES = {
    FIT: [], STATES: [], FIT + "\n": [], "": [(0, "no head")], None: [(0, "no head")], FIT + "\n    n9 --> n1": [(7, "edge without an end")],
    FIT + '\n    n4["  "]': [(7, "node without a label")], FIT + '\n    n4["a "b" c"]': [(7, "quote inside a label")], FIT + '\n    n4["NESTED_BLOCK#2"]': [(7, "internal name in a label")], FIT + '\n    n1["again"]': [(1, "name used twice")],
    FIT + '\n    n4["open': [(7, "line not understood")], FIT + "\n    n1 ==> n2": [(7, "line not understood")], STATES + "\n    OPEN --> GONE": [(5, "edge without an end")], STATES + '\n    n1["a"]': [(5, "line not understood")],
}


def test_faults(spark):
    texts = list(CASES)
    df = spark.createDataFrame(list(enumerate(texts)), "k int, mermaid string")
    got = {k: [] for k in range(len(texts))}
    for r in figure_check.faults(df, ["k"]).collect():
        got[r.k].append((r.number, r.fault))
    assert {texts[k]: sorted(v) for k, v in got.items()} == CASES


def test_bad_figure_stops_the_stage(spark, tmp_path, monkeypatch):
    source = "CREATE OR REPLACE PROCEDURE p(p_a IN NUMBER) IS\nBEGIN\n  IF p_a > 0 THEN\n    UPDATE t SET x = 1 WHERE y = p_a;\n  END IF;\nEND p;\n/"
    code = Code(spark.createDataFrame([("p.sql", source)], "file string, text string"))
    flows = dg.flows(code, ru.rules(code))
    dg.write_diagrams(flows, code, str(tmp_path / "fit"))
    assert (tmp_path / "fit" / "flows").exists()
    whole = dg.flow_text
    monkeypatch.setattr(dg, "flow_text", lambda f: whole(f).selectExpr("file_id", "object_id", "concat(mermaid, '\\n    n1 --> gone') AS mermaid"))
    with pytest.raises(ValueError, match="edge without an end"):
        dg.write_diagrams(flows, code, str(tmp_path / "bad"))
    assert not (tmp_path / "bad" / "flows").exists()
