"""Figures, the document and runs on a small code base of its own, and the words of identifiers."""

import json

import pytest
from pyspark.sql import functions as F

from quarrylens.functions import language as la
from quarrylens.plans import diagrams as dg, document as do, rules as ru
from quarrylens.plans.code import Code
from quarrylens.plans.cut import settled
from quarrylens.sources import runs

STEPS = "".join(f"    v_s := v_s + {k};\n" for k in range(50))
TEXT = f"""CREATE TABLE orders (order_id NUMBER(9) PRIMARY KEY, paid NUMBER(8,2), state VARCHAR2(9), CONSTRAINT ck_s CHECK (state IN ('NEW','PAID','LOST')), CONSTRAINT ck_p CHECK (paid > 0));
CREATE OR REPLACE PROCEDURE sp_settle_order(p_id IN NUMBER, p_amt IN OUT NUMBER) IS
  v_state VARCHAR2(9); v_s NUMBER := 0; e_too_low EXCEPTION;
BEGIN
  SELECT state INTO v_state FROM orders WHERE order_id = p_id;
  IF p_amt <= 0 THEN
    RAISE e_too_low;
  END IF;
  IF v_state = 'NEW' THEN
    UPDATE orders SET state = 'PAID', paid = p_amt WHERE order_id = p_id;
  ELSE
    UPDATE orders SET state = v_state WHERE order_id = p_id;
  END IF;
{STEPS}  COMMIT;
EXCEPTION
  WHEN e_too_low THEN ROLLBACK; RAISE;
END sp_settle_order;
/
"""


@pytest.fixture(scope="module")
def code(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("orders")
    (root / "orders.sql").write_text(TEXT)
    return Code.of(spark, str(root))


@pytest.fixture(scope="module")
def rules(code):
    return settled(ru.modality(ru.rules(code)))


@pytest.fixture(scope="module")
def flows(code, rules):
    return dg.flows(code, rules)


def said(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "make, text, words",
    [
        (la.object_title, "PROC-.SP_SETTLE_ORDER", "Settle Order"),
        (la.humanise, "e_too_low", "Too Low"),
        (la.humanise, "rec.txn_dt", "Transaction Date"),
        (la.humanise_condition, "v_a_x < p_b_y AND q IS NOT NULL", "A X is below B Y and q is present"),
        (la.humanise_condition, "v_state = 'p_x  < 1'", "State is 'p_x  < 1'"),
        (la.humanise_description, "Must hold. Defined in PROC-.SP_A, line 3. e_no_row ends it (PROC-.SP_A, line 4).", "Must hold. No Row ends it."),
        (la.short_condition, "(v_a > 1)", "a > 1"),
        (la.short_condition, "(v_a > 1) OR (v_b > ')')", "(a > 1) OR (b > ')')"),
        (la.plain_type, "VARCHAR2(20)", "Text (up to 20 characters)"),
        (la.anchor, "Part I - What's in", "part-i---whats-in"),
        (dg.branch_label, "WHEN(NO_DATA_FOUND)", "NO_DATA_FOUND"),
        (dg.branch_label, "NESTED_BLOCK#5", ""),
        (dg._text, 'a "b" (c)\n|d', "a #quot;b#quot; (c) d"),
    ],
)
def test_words(spark, make, text, words):
    assert said(spark, make(F.lit(text))) == words


def test_words_of_nothing(spark):
    for f in (la.object_title, la.humanise, la.humanise_condition, la.humanise_description, la.short_condition, la.plain_type, la.anchor):
        assert said(spark, f(F.lit(None).cast("string"))) is None
        assert said(spark, f(F.lit(""))) is not None


def test_collapse_keeps_structure(spark):
    kinds = ["DECISION" if i % 10 == 0 else "ERROR" if i == 25 else "PROCESS" for i in range(1, 31)]
    rows = [("f", "o", f"S{i}", i, None, "", k) for i, k in enumerate(kinds, 1)]
    nodes = spark.createDataFrame(rows, "file_id string, object_id string, statement_id string, seq int, parent int, scope string, kind string")
    heads = {r.statement_id: r.head for r in dg.collapse_runs(nodes, 8).collect()}
    assert all(heads[f"S{i}"] == f"S{i}" for i, k in enumerate(kinds, 1) if k != "PROCESS")
    assert heads["S9"] == "S1" and heads["S11"] == heads["S19"] == "S11" and heads["S24"] == "S21" and heads["S26"] == "S26"
    assert all(r.head == r.statement_id for r in dg.collapse_runs(nodes, 100).collect())


def test_flows(code, flows):
    report = flows.report.first()
    assert report.collapsed and not report.oversize and report.nodes < 20 and report.statements > 55
    q = dg.quality(flows).first()
    assert (q.decision_label_tier1_pct, q.branch_traceability_pct, q.leaked_identifiers) == (1.0, 1.0, 0) and dg.problems(flows).count() == 0
    text = dg.flow_text(flows).first().mermaid
    assert text.startswith('flowchart TD\n    N1(["Start"])') and "51 steps (lines 14 to 64)" in text and "amt <= 0?" in text
    tight = dg.flows(code, ru.rules(code), 5)
    assert tight.report.first().oversize and {r.kind for r in dg.warnings(tight, code).collect()} == {"OVERSIZE", "DETAIL_COLLAPSED", "DIAGRAM_NOTE"}


def test_states_are_not_guessed(code):
    assert sorted(r.state for r in dg.states(code).collect()) == ["LOST", "NEW", "PAID"]
    move = dg.transitions(code).collect()
    assert [(m.origin, m.target, m.inferred) for m in move] == [("NEW", "PAID", False)]
    assert dg.state_text(code).first().unreached == ["LOST", "NEW"]


def test_document(spark, code, rules, flows, tmp_path):
    path = tmp_path / "notes.json"
    path.write_text(json.dumps({"annotations": {"BR-001": {"note": "Asked for by law.", "owner": "Head of Sales"}, "executive_summary": {"note": "Runs since 2004."}}}))
    index = do.build_index(code, rules, flows, do.annotations(spark, f"file://{path}"))
    assert index.traceability.count() == index.requirements.count() == rules.count()
    one = index.requirements.filter("id = 'BR-001'").first()
    assert (one.owner, one.priority, one.note) == ("Head of Sales", do.BLANK, "Asked for by law.")
    document = settled(do.blocks(code, flows, index))
    assert do.broken_links(document).count() == 0
    do.write_document(document, index, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "out/brd").glob("part-*")))
    heads = [x for x in text.splitlines() if x.startswith(("## ", "### "))]
    assert [h.lstrip("# ") for h in heads] == [name for _, name in sorted(do.PARTS + do.CHAPTERS)]
    for words in ("Runs since 2004.", "Asked for by law.", "Decimal number (8 digits, 2 decimal places)", "Supplied by caller and returned changed", "Transaction boundary: all or nothing.", "Out of scope", "structurally impossible"):
        assert words in text
    assert "|---|---|---|\n| " in text.replace("\n\n", "\0")  # no blank line between a table's head and its rows
    dg.write_diagrams(flows, code, str(tmp_path / "figures"))
    assert "stateDiagram-v2" in spark.read.json(str(tmp_path / "figures/states")).first().mermaid


def test_annotations_of_no_use(spark, tmp_path):
    (tmp_path / "bad.json").write_text("{not json")
    assert do.annotations(spark, None).count() == do.annotations(spark, f"file://{tmp_path}/none.json").count() == do.annotations(spark, f"file://{tmp_path}/bad.json").count() == 0


def test_runs(spark, tmp_path):
    root = f"file://{tmp_path}/runs"
    frame = spark.createDataFrame([("a", 1), ("b", None)], "object_id string, n int")
    first = runs.write_run(spark, root, "05", {"rules": frame})
    second = runs.write_run(spark, root, "05", {"rules": frame.limit(1)}, partition_by={"rules": "object_id"})
    assert second > first and runs.latest(spark, root, "05")["run_version"] == second
    assert runs.load_run(spark, root, "05", "rules").count() == 1 and runs.load_run(spark, root, "05", "rules", first).count() == 2
    empty, version = runs.optional(spark, root, "06", "figures", "a int")
    assert version is None and empty.count() == 0
    (tmp_path / "runs/07").mkdir()
    (tmp_path / "runs/07/latest.json").write_text("{")
    assert runs.optional(spark, root, "07", "x", "a int")[1] is None
    with pytest.raises(FileNotFoundError):
        runs.load_run(spark, root, "06", "figures")
