"""The code base layer on small sources of its own: discovery, reading, metrics, calls, schema, rules, graph and questions."""

import pytest

from quarrylens.plans import code as c, graph as gr, rules as ru, schema as sc
from quarrylens.plans.code import Code
from quarrylens.sources.plsql import facts_of

SOURCES = {
    "a/shop.sql": """CREATE SEQUENCE seq_sale START WITH 10 INCREMENT BY 5 NOCACHE;
CREATE TABLE shop (shop_id NUMBER GENERATED ALWAYS AS IDENTITY, kind VARCHAR2(9), full_name VARCHAR2(40) GENERATED ALWAYS AS (kind || '!') VIRTUAL, -- SMALL, LARGE
  CONSTRAINT pk_shop PRIMARY KEY (shop_id));
CREATE TABLE sale (sale_id NUMBER(9) PRIMARY KEY, shop_id NUMBER, boss_id NUMBER, price NUMBER(8,2) DEFAULT 0 NOT NULL, state VARCHAR2(5),
  mode_ VARCHAR2(9), -- CASH, CARD
  CONSTRAINT ck_price CHECK (price > 0) DISABLE, CONSTRAINT ck_state CHECK (state IN ('OPEN','DONE')),
  CONSTRAINT fk_sale FOREIGN KEY (boss_id) REFERENCES shop (shop_id) ON DELETE CASCADE) PARTITION BY HASH (sale_id) PARTITIONS 4;
CREATE UNIQUE INDEX ux_sale ON sale (shop_id, price);
CREATE OR REPLACE VIEW open_sale AS SELECT * FROM sale WHERE state = 'OPEN';
CREATE PUBLIC SYNONYM deals FOR app.sale;
COMMENT ON COLUMN sale.price IS 'What it''s sold for';
""",
    "b/pack.sql": """CREATE OR REPLACE PACKAGE BODY app.till IS
  FUNCTION due(p_n NUMBER) RETURN NUMBER IS BEGIN RETURN p_n * 2; END due;
  PROCEDURE pay(p_n IN NUMBER, p_out OUT NUMBER) IS
    v_price deals.price%TYPE; v_bad sale.nothing%TYPE; e_low EXCEPTION;
  BEGIN
    IF p_n BETWEEN 1 AND 5 OR p_n IS NULL THEN RAISE e_low; END IF;
    <<again>>
    LOOP
      UPDATE deals SET price = price + p_n, state = 'DONE' WHERE sale_id = p_n;
      COMMIT;
      EXIT WHEN p_n > 3 AND p_n < 9;
    END LOOP again;
    CASE p_n WHEN 1 THEN refund(p_n); ELSE outside.log_it(q'[it's; END]'); END CASE;
    EXECUTE IMMEDIATE 'DELETE FROM x' USING p_n;
    p_out := CASE WHEN p_n > 1 THEN 1 ELSE 0 END;
  EXCEPTION WHEN e_low OR OTHERS THEN ROLLBACK; RAISE;
  END pay;
  PROCEDURE refund(p_n NUMBER) IS BEGIN INSERT INTO sale (sale_id) VALUES (seq_sale.NEXTVAL); END;
END till;
/
""",
    "b/bad.sql": "CREATE PROCEDURE broken IS BEGIN IF THEN END IF END broken;\n/\nCREATE PROCEDURE fine IS BEGIN NULL; END fine;\n/\n",
    "b/hidden.sql": "CREATE PACKAGE BODY app.secret wrapped\na000\nzz==\n/\n",
    "b/empty.sql": "",
    "b/skip_old.sql": "CREATE TABLE never (a NUMBER);",
}


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("c+(o)de")
    for name, text in SOURCES.items():
        (root / name).parent.mkdir(exist_ok=True)
        (root / name).write_text(text, encoding="latin-1")
    return Code.of(spark, str(root))


@pytest.fixture(scope="module")
def graph(shop):
    return gr.build(shop)


def rows(df, *names):
    return sorted(tuple(r) for r in df.select(*names).collect())


def test_discovery_and_objects(shop):
    assert {r.file for r in shop.facts.select("file").collect()} == set(SOURCES) - {"b/skip_old.sql"}  # an empty file is listed too
    found = dict(rows(shop.rows("objects"), "object_id", "parse_status"))
    assert found["PKGB-APP.TILL::PAY"] == found["PROC-.FINE"] == "parsed"
    assert found["PKGB-APP.SECRET"] == "skipped_wrapped" and found["PROC-.BROKEN"] == "parse_error"
    assert {r.type for r in shop.rows("issues").collect()} == {"wrapped_object_skipped", "parse_error"}


def test_metrics(shop):
    pay = c.complexity(shop).filter("object_id LIKE '%PAY'").first()
    assert (pay.n_if, pay.n_loop, pay.n_handler, pay.n_case_when, pay.n_logical) == (1, 1, 1, 2, 2) and pay.cyclomatic == 8
    t = c.transactions(shop).filter("object_id LIKE '%PAY'").first()
    assert not t.is_atomic and t.commit_inside_loop == 1 and [h.hazard for h in t.hazards] == ["COMMIT_INSIDE_LOOP"]
    assert c.loops(shop).first().termination_pattern == "EXIT"
    assert rows(c.calls(shop), "call_target", "call_target_object_id", "status") == [("OUTSIDE.LOG_IT", None, "unresolved_reference"), ("REFUND", "PKGB-APP.TILL::REFUND", "resolved")]


def test_schema(shop):
    price = sc.columns(shop).filter("table_name = 'SALE' AND name = 'PRICE'").first()
    assert (price.pyspark_type, price.nullable, price.default, price.comment) == ("DecimalType(8,2)", False, "0", "What it's sold for")
    assert rows(sc.columns(shop).filter("enum_values IS NOT NULL"), "name", "enum_values", "enum_source") == [("FULL_NAME", ["SMALL", "LARGE"], "comment_only"), ("MODE_", ["CASH", "CARD"], "comment_only"), ("STATE", ["OPEN", "DONE"], "check_constraint")]
    assert {r.source_kind for r in sc.rule_candidates(shop).collect()} == {"check_constraint", "virtual_column", "unique_index", "view_filter"}
    assert rows(sc.inferred_relationships(shop), "from_table", "from_column", "to_table") == [("SALE", "SHOP_ID", "SHOP")]
    assert rows(sc.type_references(shop), "reference", "resolved")[-1] == ("SALE.NOTHING%TYPE", False)
    assert rows(sc.table_access(shop).filter("crud = 'U'"), "table_name") == [("SALE",)] and sc.unknown_tables(shop).count() == 0
    part = shop.rows("tables").filter("table_name = 'SALE'").first()
    assert (part.partition_strategy, part.partition_columns, part.partition_count) == ("HASH", ["SALE_ID"], 4)
    lines = [r.line for r in sc.erd(shop).orderBy("rank", "table_name", "line").collect()]
    assert lines[0] == "erDiagram" and any("[CASCADE]" in x for x in lines)


def test_rules_and_evaluation(spark, shop):
    rules = ru.rules(shop)
    assert rules.select("rule_id").distinct().count() == rules.count()
    assert {(r.kind, r.is_obligation) for r in rules.filter("object_id LIKE '%PAY' AND line = 6").collect()} == {("named_exception", True)}
    off = ru.modality(rules).filter("is_enforced = false").first()
    assert off.modality == "deontic" and "NOT being enforced" in off.formal_statement and off.verification_method == "Inspection - DISABLED"
    truth = spark.createDataFrame([("o", 1, "T1", "p_rate", [10]), ("o", 2, "T2", "x", [11]), ("o", 3, "T3", "x", [40])], "object_id string, ordinal int, truth_id string, subject string, source_lines array<int>")
    found = spark.createDataFrame([("o", "R1", "Rate", 11), ("o", "R2", "Other", 12), ("o", "R3", "Far", 20)], "object_id string, rule_id string, name string, line int")
    r = ru.evaluate(truth, found).first()
    assert (r.matched, r.precision, r.recall, r.f1) == (2, 0.6667, 0.6667, 0.6667)


def test_graph_and_questions(graph):
    ends = graph.nodes.select("key")
    assert graph.edges.join(ends.withColumnRenamed("key", "source"), "source", "left_anti").count() == 0
    assert graph.nodes.filter("label = 'BlindSpot'").count() == 4 and gr.violations(graph).count() == 0
    assert gr.ask(graph, "what breaks if I change SALE.PRICE")["answer"].count() >= 2
    call = gr.ask(graph, "how do I call PAY")
    assert call["subject"] == "PKGB-APP.TILL::PAY" and [r.name for r in call["answer"].collect()] == ["P_N", "P_OUT"]
    assert [r.key for r in gr.ask(graph, "which tables are never used")["answer"].collect()] == ["SHOP"]
    assert not gr.ask(graph, "what breaks if I change NO_SUCH.FIELD")["ok"] and gr.ask(graph, "what is love")["suggestions"] and not gr.ask(graph, "")["ok"]
    for intent in gr.INTENTS:
        asked = gr.ask(graph, intent[1])
        assert asked["ok"] or "could not identify" in asked["reason"]
    lines = [r.line for r in gr.load_script(graph).collect()]
    assert not any(line.startswith("CREATE (") for line in lines) and lines[0].startswith("CREATE CONSTRAINT")


def test_texts_without_facts():
    for text in (None, "", "-- only a comment", "/* open", "CREATE", "CREATE TABLE", "'open text", "BEGIN " * 3000):
        assert isinstance(facts_of(text), dict)
