"""Graphs and rules from runs: the same as from the source with all of them, and with each one left out only what rests on it is missing."""

import argparse
import json

import pytest
from pyspark.sql import functions as F

from quarrylens import cli
from quarrylens.plans import graph as gr, stages as st
from quarrylens.plans.code import Code
from quarrylens.sources import runs

SOURCE = """CREATE TABLE branch (id NUMBER(9) PRIMARY KEY, city VARCHAR2(20));
CREATE TABLE acct (id NUMBER(9) PRIMARY KEY, branch_id NUMBER(9) REFERENCES branch(id), balance NUMBER(18,2), status VARCHAR2(9), CONSTRAINT ck_st CHECK (status IN ('OPEN', 'CLOSED', 'DORMANT')));
CREATE SEQUENCE acct_seq START WITH 1;
CREATE INDEX ix_acct ON acct (branch_id);
CREATE OR REPLACE PROCEDURE sp_close(p_id IN NUMBER) IS
  v_fee NUMBER;
BEGIN
  SELECT SUM(balance) * 0.01 + 5 INTO v_fee FROM acct WHERE id = p_id;
  UPDATE acct SET status = 'CLOSED', balance = balance - v_fee WHERE id = p_id AND status = 'OPEN';
END sp_close;
/
CREATE OR REPLACE PROCEDURE sp_pay_out(p_id IN NUMBER, p_amt IN NUMBER) IS
BEGIN
  IF p_amt <= 0 THEN
    RAISE_APPLICATION_ERROR(-20001, 'no');
  END IF;
  UPDATE acct SET balance = balance - p_amt WHERE id = p_id;
  sp_close(p_id);
END sp_pay_out;
/
"""


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    source, out = tmp_path_factory.mktemp("source"), tmp_path_factory.mktemp("runs")
    (source / "a.sql").write_text(SOURCE)
    versions = st.write_source_runs(spark, str(source), str(out))
    return str(source), str(out), versions


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_all_runs_give_the_source_graph(spark, made):
    source, out, versions = made
    assert list(versions) == list(st.STAGES)
    at = st.Artefacts(spark, out)
    assert at.absent == [] and at.versions == versions
    a, b = gr.build(Code.of(spark, source)), st.graph_from_runs(at)
    ends = ["type", "source_label", "source", "target_label", "target"]
    assert rows(a.nodes.filter("label <> 'Gap'").select("label", "key", "name", "line")) == rows(b.nodes.filter("label <> 'Gap'").select("label", "key", "name", "line"))
    assert rows(a.nodes.filter("label = 'Gap'").select("key")) <= rows(b.nodes.filter("label = 'Gap'").select("key"))  # the document's also has the figures' matters
    moves = b.edges.filter("type = 'MOVES_TO'")
    assert rows(b.edges.filter("type <> 'MOVES_TO' AND source_label <> 'Gap'").select(ends)) == rows(a.edges.filter("source_label <> 'Gap'").select(ends))
    assert rows(moves.select("source", "target")) == {("ACCT.STATUS=OPEN", "ACCT.STATUS=CLOSED")}
    assert b.dropped.agg(F.sum("dropped")).first()[0] in (0, None)


GONE = {  # stage -> labels and relationship types that rest on it
    "inventory": ({"File"}, {"DEFINES"}),
    "data": ({"Table", "Column", "State", "Sequence", "Index"}, {"HAS_COLUMN", "READS_COLUMN", "WRITES_COLUMN", "REFERENCES", "HAS_STATE", "INDEXES", "MOVES_TO"}),
    "logic": (set(), {"DETERMINES", "READS_COLUMN", "WRITES_COLUMN"}),
    "rules": ({"BusinessRule", "RuleSet"}, {"IMPLEMENTED_AT", "ENFORCED_IN", "BELONGS_TO", "CONSTRAINS"}),
    "diagrams": (set(), {"MOVES_TO"}),
    "document": ({"Gap"}, set()),
}


@pytest.mark.parametrize("stage", list(GONE))
def test_one_run_left_out(spark, made, stage):
    full, part = st.graph_from_runs(st.Artefacts(spark, made[1])), st.Artefacts(spark, made[1], leave_out=(stage,))
    assert part.absent == [stage]
    g = st.graph_from_runs(part)
    labels, types = ({r[0] for r in df.select(c).distinct().collect()} for df, c in ((g.nodes, "label"), (g.edges, "type")))
    gone_labels, gone_types = GONE[stage]
    assert not labels & gone_labels and not types & gone_types
    all_labels, all_types = ({r[0] for r in df.select(c).distinct().collect()} for df, c in ((full.nodes, "label"), (full.edges, "type")))
    assert gone_labels <= all_labels and gone_types <= all_types
    assert all_labels - labels == gone_labels
    if stage in ("logic", "document"):
        left = g.nodes.filter("label = 'BusinessRule' AND detail LIKE '%formal_statement%'").count()
        assert left == 0 if stage == "document" else left > 0
        assert g.nodes.filter("label = 'Object' AND detail IS NOT NULL").count() == (0 if stage == "logic" else 2)


def test_rules_without_logic(spark, made):
    """Rules from runs: without logic only those that derive a variable are missing; without the data model those of the schema, too."""
    kinds = lambda *out: {r[0] for r in st.rules_of(st.Artefacts(spark, made[1], leave_out=("rules", *out))).select("kind").distinct().collect()}
    everything = kinds()
    assert everything == {r[0] for r in runs.load_run(spark, made[1], "rules", "rules").select("kind").distinct().collect()}
    assert everything - kinds("logic") == {"variable_derivation"} and any(k.startswith("ddl") for k in everything - kinds("data"))


def test_no_parser_and_broken_runs(spark, made, tmp_path):
    with pytest.raises(FileNotFoundError, match="parser"):
        st.Artefacts(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        st.Artefacts(spark, made[1], leave_out=("parser",))
    said = []
    args = argparse.Namespace(stage="graph", question=None, source=None, out=str(tmp_path), annotations=None, rows=10)
    with pytest.raises(FileNotFoundError):  # main answers it with exit code 1
        cli.run(spark, args, said.append)
    (tmp_path / "rules").mkdir()
    (tmp_path / "rules" / "latest.json").write_text("{not json")
    runs.write_run(spark, str(tmp_path), "parser", st.tables_of(Code(spark.createDataFrame([("a.sql", SOURCE)], "file string, text string")), "parser"))
    assert set(st.Artefacts(spark, str(tmp_path)).absent) == set(st.STAGES) - {"parser"}


def test_commands_over_runs(spark, made, tmp_path):
    said = []
    ran = lambda stage, question=None: cli.run(spark, argparse.Namespace(stage=stage, question=question, source=None, out=made[1], annotations=None, rows=10), said.append)
    assert ran("ask", "What is the calling interface of pay out?") == runs.EXIT_OK and [r["name"] for r in json.loads(said[-1])["rows"]] == ["P_ID", "P_AMT"]
    assert ran("parser") == runs.EXIT_INVALID and ran("ask", "What is the weather like?") == runs.EXIT_REFUSED
    assert ran("logic") == runs.EXIT_OK and json.loads(said[-1])["absent"] == ["logic"]
