"""Rules, figures, document and graph over routines and tables written from the driver's tables, through the library's own operators.

The routines are those of `code_queries`: what each analysis must find follows from a routine's key, so SQL can say it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources import inventory as inv, runs
from . import code as c, diagrams as dg, document as do, figure_check, graph as gr, rules as ru, schema as sc, stages as st
from .code import Code
from .code_queries import _ROUTINE, _TABLE, _flows, _routines, _tables
from .cut import big, fresh

QUERIES: dict = {}
SQL: dict[str, str] = {}
_K = "SELECT c_custkey AS k, 'PROC-APP.P_' || c_custkey AS object_id, CAST(c_custkey % 2 = 0 AS BIGINT) AS e, CAST(c_custkey % 3 = 0 AS BIGINT) AS l, CAST(c_custkey % 6 = 0 AS BIGINT) AS lc, CAST(c_custkey % 5 = 0 AS BIGINT) AS m, CAST(c_custkey % 7 = 0 AS BIGINT) AS o FROM customer"
#: Statements of a routine before its handlers, and all of them.
_S = f"SELECT *, 7 + e + 2 * l + lc + m + 3 * o AS statements FROM ({_K})"


def _query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _read(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- enforcement, rules ---------------------------------------------------------------------------------------------------------
@_query("SELECT status, validated, count(*) AS n, status = 'ENABLED' AS is_enforced, CASE WHEN status = 'DISABLED' THEN 'not_enforced' WHEN validated = 'VALIDATED' THEN 'enforced' ELSE 'enforced_new_data_only' END AS confidence, CAST(CASE WHEN status = 'DISABLED' THEN 2 WHEN validated = 'VALIDATED' THEN 5 ELSE 4 END AS INTEGER) AS signal_strength, NOT (status = 'ENABLED' AND validated = 'VALIDATED') AS requires_sme_review FROM (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'ENABLED' ELSE 'DISABLED' END AS status, CASE WHEN c_custkey % 3 = 0 THEN 'VALIDATED' ELSE 'NOT_VALIDATED' END AS validated FROM customer) GROUP BY ALL")
def enforcement_matrix(spark, sf_dir):
    k = F.col("c_custkey")
    rows = _read(spark, sf_dir, "customer").select(F.when(k % 2 == 0, "ENABLED").otherwise("DISABLED").alias("status"), F.when(k % 3 == 0, "VALIDATED").otherwise("NOT_VALIDATED").alias("validated"))
    return sc.enforcement(rows).groupBy("status", "validated", "is_enforced", "confidence", "signal_strength", "requires_sme_review").agg(F.count(F.lit(1)).alias("n"))


@_query("SELECT 'T_' || s_suppkey AS object_id, CASE WHEN s_suppkey % 3 = 0 THEN 'deontic' ELSE 'alethic' END AS modality, CASE WHEN s_suppkey % 3 = 0 THEN 'Inspection - DISABLED' ELSE 'Inspection' END AS verification_method, s_suppkey % 3 = 0 AS said_open FROM supplier")
def modality_verification(spark, sf_dir):
    rows = ru.modality(ru.deduplicate(ru.mined(_tables(spark, sf_dir))).filter("kind = 'ddl_check_constraint'"))
    return rows.select("object_id", "modality", "verification_method", F.col("formal_statement").contains("NOT being enforced").alias("said_open"))


@_query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'status' ELSE 'v_bal' END AS lhs, CASE WHEN c_custkey % 2 = 0 THEN '=' ELSE '<' END AS op, CASE WHEN c_custkey % 2 = 0 THEN '''A''' ELSE CAST(c_custkey AS VARCHAR) END AS rhs, CASE WHEN c_custkey % 2 = 0 THEN 'FIELD_VALUE_COMPARE' ELSE 'THRESHOLD_COMPARE' END AS one, 'MULTI_CONDITION' AS many FROM customer")
def clause_scoring(spark, sf_dir):
    one = F.when(F.col("c_custkey") % 2 == 0, "status = 'A'").otherwise(F.concat(F.lit("v_bal < "), "c_custkey"))
    both = F.concat(F.lit("x > y AND "), one)
    rows = _read(spark, sf_dir, "customer").select("c_custkey", ru.best_clause(both).alias("b"), ru.classify_pattern(one).alias("one"), ru.classify_pattern(both).alias("many"))
    return rows.select("c_custkey", "b.lhs", "b.op", "b.rhs", "one", "many")


@_query("SELECT doc_id, 'BR-' || lpad(CAST(n AS VARCHAR), CAST(greatest(3, len(CAST(n AS VARCHAR))) AS INTEGER), '0') AS rule_id FROM (SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, source, doc_id) AS n FROM documents)")
def rule_numbering(spark, sf_dir):
    return ru.numbered(_read(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").alias("signal_strength"), F.col("source").alias("name"), F.col("doc_id").alias("raw_key"))).select("doc_id", "rule_id")


@_query("SELECT lang, source, doc_id FROM (SELECT lang, source, doc_id, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id % 2 DESC, n_chars DESC, lpad(CAST(doc_id AS VARCHAR), 12, '0')) AS r FROM documents) WHERE r = 1")
def rule_dedup(spark, sf_dir):
    d = _read(spark, sf_dir, "documents")
    rows = d.select("lang", "source", "doc_id", F.concat_ws("|", "lang", "source").alias("raw_key"), (F.col("doc_id") % 2 == 1).alias("is_obligation"), F.col("n_chars").alias("signal_strength"), F.lit("k").alias("kind"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("name"))
    return ru.deduplicate(rows).select("lang", "source", "doc_id")


@_query(f"SELECT object_id, 3 + e AS rules FROM ({_K})")
def rule_sets(spark, sf_dir):
    """One set for each routine: two or three conditions, the derivation, and the handled error, of which an ELSE is one."""
    rules = ru.deduplicate(ru.mined(_routines(spark, sf_dir))).withColumn("rule_id", F.concat(F.lit("R-"), "raw_key"))
    return ru.rule_sets(rules).select("object_id", (F.size("rule_ids") - 1).cast("long").alias("rules"))


@_query(f"SELECT object_id, 'OTHERS' AS handled FROM ({_K}) WHERE o = 1")
def error_catalogue(spark, sf_dir):
    return ru.error_catalogue(_routines(spark, sf_dir)).select("object_id", F.array_join("handler_for", ",").alias("handled"))


@_query("SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'COMPLIANCE' WHEN 1 THEN 'LIMIT_CHECK' WHEN 2 THEN 'CALCULATION' WHEN 3 THEN 'ROUTING' ELSE 'VALIDATION' END AS category, CASE c_custkey % 5 WHEN 0 THEN 'Kyc Flag' WHEN 1 THEN 'Daily Limit' WHEN 2 THEN 'Rate' WHEN 3 THEN 'Branch' ELSE 'Account' END AS words FROM customer")
def rule_words(spark, sf_dir):
    said = F.element_at(F.array(*map(F.lit, ("p_kyc_flag", "v_daily_limit", "v_rate", "in_branch", "p_acct"))), (F.col("c_custkey") % 5 + 1).cast("int"))
    return _read(spark, sf_dir, "customer").select("c_custkey", ru.classify_category(F.concat(F.lit("x."), said)).alias("category"), ru.business_name(F.concat(F.lit("x."), said)).alias("words"))


@_query("SELECT 'o' || c_nationkey AS object_id, count(*) AS truth, count(*) FILTER (c_custkey % 3 <> 0) + count(*) FILTER (c_custkey % 3 = 1) AS extracted, count(*) FILTER (c_custkey % 3 <> 0) AS matched FROM customer GROUP BY c_nationkey")
def closest_match_eval(spark, sf_dir):
    """Truth rules far apart: of three the first is met within the tolerance and has a second rule near it, the next is met exactly, the last not at all."""
    t = _read(spark, sf_dir, "customer").select(F.concat(F.lit("o"), "c_nationkey").alias("object_id"), "c_custkey")
    truth = t.select("object_id", F.col("c_custkey").cast("int").alias("ordinal"), F.col("c_custkey").cast("string").alias("truth_id"), F.lit("x").alias("subject"), F.array((F.col("c_custkey") * 100).cast("int")).alias("source_lines"))
    near = t.filter("c_custkey % 3 <> 0").select("object_id", F.concat(F.lit("a"), "c_custkey").alias("rule_id"), F.lit("x").alias("name"), (F.col("c_custkey") * 100 + F.when(F.col("c_custkey") % 3 == 1, 2).otherwise(0)).cast("int").alias("line"))
    far = t.filter("c_custkey % 3 = 1").select("object_id", F.concat(F.lit("b"), "c_custkey").alias("rule_id"), F.lit("x").alias("name"), (F.col("c_custkey") * 100 + 30).cast("int").alias("line"))
    return ru.evaluate(truth, near.unionByName(far)).select("object_id", "truth", "extracted", "matched")


@_query("SELECT CAST(sum(m) AS BIGINT) AS matched, CAST(sum(e) AS BIGINT) AS extracted, CAST(sum(t) AS BIGINT) AS truth, round(sum(m) / CAST(sum(e) AS DOUBLE), 4) AS precision, round(sum(m) / CAST(sum(t) AS DOUBLE), 4) AS recall FROM (SELECT count(*) AS t, count(*) FILTER (c_custkey % 3 <> 0) + count(*) FILTER (c_custkey % 3 = 1) AS e, count(*) FILTER (c_custkey % 3 <> 0) AS m FROM customer)")
def micro_average(spark, sf_dir):
    return ru.micro_averaged(closest_match_eval(spark, sf_dir)).select("matched", "extracted", "truth", "precision", "recall")


# -- code -----------------------------------------------------------------------------------------------------------------------
@_query(f"SELECT object_id, depth, n FROM (SELECT object_id, 0 AS depth, 3 + l + m + o + 1 AS n FROM ({_K}) UNION ALL SELECT object_id, 1, 3 + e + l + lc + 2 * o + 0 * l FROM ({_K})) WHERE n > 0")
def nesting_depth(spark, sf_dir):
    return c._nesting(_routines(spark, sf_dir)).groupBy("object_id", F.col("nesting").cast("int").alias("depth")).agg(F.count(F.lit(1)).alias("n"))


@_query(f"SELECT object_id, CAST(segment AS INTEGER) AS segment, committed FROM (SELECT object_id, 0 AS segment, lc + m > 0 AS committed FROM ({_K}) UNION ALL SELECT object_id, 1, m = 1 FROM ({_K}) WHERE lc = 1)")
def txn_segments(spark, sf_dir):
    return c.transaction_segments(_routines(spark, sf_dir)).select("object_id", "segment", "committed")


@_query(f"SELECT object_id, 'COUNTED_OR_CURSOR_LOOP' AS termination_pattern, FALSE AS warns FROM ({_K}) WHERE l = 1")
def loop_ends(spark, sf_dir):
    return c.loops(_routines(spark, sf_dir)).select("object_id", "termination_pattern", "warns")


@_query(f"SELECT 'PROC-APP.P_' || c_custkey AS object_id FROM customer WHERE c_custkey - 1 NOT IN (SELECT c_custkey FROM customer)")
def no_internal_callers(spark, sf_dir):
    return c.no_internal_callers(_routines(spark, sf_dir)).select("object_id")


@_query(f"SELECT object_id, 'IF v_n > ' || k || ' AND v_n < 9 THEN' AS second, 'EXCEPTION HANDLING:' AS heading FROM ({_K})")
def pseudocode_lines(spark, sf_dir):
    rows = c.pseudocode(_routines(spark, sf_dir))
    return rows.select("object_id", F.trim(F.col("pseudocode")[1]).alias("second"), F.element_at(F.filter("pseudocode", lambda x: x.startswith("EXCEPTION")), 1).alias("heading"))


@_query(f"SELECT object_id, object_id || ' is a ' || CASE WHEN l = 1 THEN 'BATCH_PROCESSOR' ELSE 'SINGLE_RECORD_TRANSACTION' END || ' of ' || statements || ' statements (cyclomatic ' || (4 + e + l + o) || ', cognitive ' || (4 + l + o + e) || '), including handlers of ' || CASE WHEN o = 1 THEN 'NO_DATA_FOUND, OTHERS' ELSE 'NO_DATA_FOUND' END || '.' AS narrative FROM ({_S})")
def narratives(spark, sf_dir):
    return c.narrative(_routines(spark, sf_dir)).select("object_id", "narrative")


# -- figures and document ---------------------------------------------------------------------------------------------------------
@_query("SELECT conv_id, turn, 'R-' || conv_id || '-' || turn AS rule_id FROM conversations")
def span_join(spark, sf_dir):
    """Each turn is a span of its own line and the next: the rule at its first line comes before a later one."""
    t = _read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("file_id"), F.lit("o").alias("object_id"), "conv_id", "turn")
    spans = t.select("file_id", "object_id", F.struct("conv_id", "turn").alias("id"), F.col("turn").alias("first"), (F.col("turn") + 1).alias("last"))
    rules = t.select("file_id", "object_id", F.concat_ws("-", F.lit("R"), "conv_id", "turn").alias("rule_id"), F.lit("x").alias("condition"), F.col("turn").alias("line"), F.lit(3).alias("signal_strength"), F.lit("conditional_branch").alias("kind"))
    return dg.rules_in_span(spans, rules).select("id.conv_id", "id.turn", "rule_id")


@_query("SELECT conv_id, min(turn) AS first_turn, count(*) AS n FROM (SELECT conv_id, turn, role, sum(brk) OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM (SELECT conv_id, turn, role, CASE WHEN role = 'user' THEN 1 ELSE 0 END AS brk FROM conversations)) WHERE role <> 'user' GROUP BY conv_id, island")
def islands_collapse(spark, sf_dir):
    """Turns as statements of one routine for each conversation, users' turns protected: runs between them are merged."""
    t = _read(spark, sf_dir, "conversations")
    nodes = t.select(F.col("conv_id").cast("string").alias("file_id"), F.lit("o").alias("object_id"), F.lit(None).cast("int").alias("parent"), F.lit("").alias("scope"), F.col("turn").alias("seq"), F.when(F.col("role") == "user", "DECISION").otherwise("PROCESS").alias("kind"), F.concat_ws("-", "conv_id", F.lpad(F.col("turn").cast("string"), 9, "0")).alias("statement_id"), "conv_id", "turn")
    merged = dg.collapse_runs(nodes, 0).filter("kind = 'PROCESS'")
    return merged.groupBy("conv_id", "head").agg(F.min("turn").alias("first_turn"), F.count(F.lit(1)).alias("n")).drop("head")


@_query(f"SELECT TRUE AS decisions_ruled, TRUE AS branches_ruled, 0 AS leaked, CAST(sum(statements + 2) AS BIGINT) AS nodes, CAST(max(statements + 2) AS INTEGER) AS most FROM ({_S})")
def quality_ratios(spark, sf_dir):
    q = dg.quality(_flows(spark, sf_dir, dg.NODE_BUDGET))
    return q.select((F.col("decision_label_tier1_pct") == 1).alias("decisions_ruled"), (F.col("branch_traceability_pct") == 1).alias("branches_ruled"), F.col("leaked_identifiers").cast("int").alias("leaked"), F.col("total_nodes").alias("nodes"), F.col("max_nodes_any_diagram").alias("most"))


@_query(f"SELECT object_id, 'DETAIL_COLLAPSED' AS kind, statements || ' statements are shown as ' || (statements + 2 - lc - m) || ' nodes' AS message FROM ({_S}) WHERE statements + 2 > 12 AND lc + m > 0")
def figure_warnings(spark, sf_dir):
    return dg.warnings(_flows(spark, sf_dir, 12), _routines(spark, sf_dir)).filter("kind = 'DETAIL_COLLAPSED'").select(F.col("subject").alias("object_id"), "kind", "message")


@_query("""SELECT 'PROC-APP.P_' || c_custkey AS object_id, CASE c_custkey % 6 WHEN 1 THEN 'edge without an end' WHEN 2 THEN 'quote inside a label' WHEN 3 THEN 'internal name in a label' WHEN 4 THEN 'line not understood' ELSE 'name used twice' END AS fault
FROM customer WHERE c_custkey % 6 <> 0""")
def figure_faults(spark, sf_dir):
    """The written figures of all routines, five of six of them with a line that is wrong in one way; figures left alone have no fault."""
    # Rules have their keys for numbers here; the stage gives them numbers of their own.
    texts = dg.flow_text(_flows(spark, sf_dir, dg.NODE_BUDGET)).withColumn("mermaid", F.regexp_replace("mermaid", 'BR-[^"]*', "BR-001"))
    k = F.regexp_extract("object_id", r"(\d+)$", 1).cast("long") % 6
    more = F.when(k == 1, "\n    nobody --> nowhere").when(k == 2, '\n    x1["says "no" twice"]').when(k == 3, '\n    x1["after STMT_0004"]').when(k == 4, "\n  then nothing [").when(k == 5, '\n    x1["a"]\n    x1["b"]').otherwise("")
    return figure_check.faults(texts.withColumn("mermaid", F.concat("mermaid", more)), ["file_id", "object_id"]).select("object_id", "fault")


@_query(f"SELECT object_id, '| P ' || k || ' | ACCOUNTS: RU' || CASE WHEN l + e > 0 THEN ', AUDIT: ' || CASE WHEN l = 1 THEN 'C' ELSE '' END || CASE WHEN e = 1 THEN 'D' ELSE '' END ELSE '' END || ' |' AS line FROM ({_K})")
def crud_markdown(spark, sf_dir):
    return dg.crud_markdown(_routines(spark, sf_dir))


@_query(f"SELECT object_id, 4 + e AS rules, 4 + e AS with_line, 'Test' AS verification_method FROM ({_K})")
def traceability(spark, sf_dir):
    rules = ru.deduplicate(ru.mined(_routines(spark, sf_dir))).withColumn("rule_id", F.concat(F.lit("R-"), "raw_key"))
    rows = do.traceability(do.requirements(rules, do.annotations(spark, None)))
    return rows.groupBy("object_id", "verification_method").agg(F.count(F.lit(1)).alias("rules"), F.count("line").alias("with_line"))


# -- graph ------------------------------------------------------------------------------------------------------------------------
_GRAPHS: dict[tuple[str, str], gr.Graph] = {}


def _graph(spark, sf_dir: str) -> gr.Graph:
    """The graph of the routines and of tables that they use; built once for an application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _GRAPHS:
        files = _read(spark, sf_dir, "customer").select(F.expr("concat('r/', c_custkey, '.sql')").alias("file"), F.expr(_ROUTINE).alias("text"))
        files = files.unionByName(_read(spark, sf_dir, "supplier").select(F.expr("concat('t/', s_suppkey, '.sql')").alias("file"), F.expr(_TABLE).alias("text")))
        used = spark.createDataFrame([("u/accounts.sql", "CREATE TABLE accounts (id NUMBER(9), balance NUMBER(18,2));"), ("u/audit.sql", "CREATE TABLE audit (id NUMBER(9));")], "file string, text string")
        _GRAPHS[key] = gr.build(Code(files.unionByName(used)))
    return _GRAPHS[key]


@_query(f"""SELECT 'File' AS label, (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier) + 2 AS n UNION ALL SELECT 'Object', count(*) FROM customer UNION ALL SELECT 'Statement', CAST(sum(statements) AS BIGINT) FROM ({_S})
UNION ALL SELECT 'Parameter', 2 * count(*) FROM customer UNION ALL SELECT 'Table', count(*) + 2 FROM supplier UNION ALL SELECT 'Column', 3 * count(*) + 3 FROM supplier UNION ALL SELECT 'State', 2 * count(*) FROM supplier
UNION ALL SELECT 'BusinessRule', (SELECT CAST(sum(4 + e) AS BIGINT) FROM ({_K})) + (SELECT count(*) FROM supplier) UNION ALL SELECT 'RuleSet', (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier) UNION ALL SELECT 'BlindSpot', 4""")
def graph_nodes(spark, sf_dir):
    """Gaps and variables apart, which follow from other queries."""
    return _graph(spark, sf_dir).nodes.filter("label NOT IN ('Gap', 'Variable')").groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@_query(f"""SELECT 'CALLS' AS type, count(*) AS n FROM customer WHERE c_custkey + 1 IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'HAS_COLUMN', 3 * count(*) + 3 FROM supplier UNION ALL SELECT 'HAS_PARAMETER', 2 * count(*) FROM customer
UNION ALL SELECT 'CONTAINS_STATEMENT', CAST(sum(statements) AS BIGINT) FROM ({_S}) UNION ALL SELECT 'FOLLOWS', CAST(sum(2 + l + lc + m + o) AS BIGINT) FROM ({_K}) UNION ALL SELECT 'BRANCHES_TO', CAST(sum(3 + e + l + o) AS BIGINT) FROM ({_K}) UNION ALL SELECT 'LOOPS_BACK_TO', CAST(sum(l) AS BIGINT) FROM ({_K})
UNION ALL SELECT 'HAS_STATE', 2 * count(*) FROM supplier""")
def graph_edges(spark, sf_dir):
    return _graph(spark, sf_dir).edges.filter("type IN ('CALLS', 'HAS_COLUMN', 'HAS_PARAMETER', 'CONTAINS_STATEMENT', 'FOLLOWS', 'BRANCHES_TO', 'LOOPS_BACK_TO', 'HAS_STATE')").groupBy("type").agg(F.count(F.lit(1)).alias("n"))


@_query("SELECT count(*) AS edges, CAST(0 AS BIGINT) AS loose, CAST(0 AS BIGINT) AS repeated FROM customer")
def endpoint_guard(spark, sf_dir):
    """Every edge has both its ends and none is there twice; counted against the routines by the edges that define them."""
    g = _graph(spark, sf_dir)
    ends = g.nodes.select("label", "key")
    loose = g.edges.join(big(ends.toDF("source_label", "source")), ["source_label", "source"], "left_anti").unionByName(g.edges.join(big(ends.toDF("target_label", "target")), ["target_label", "target"], "left_anti"))
    twice = g.edges.groupBy(*g.edges.columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return g.edges.filter("type = 'DEFINES'").agg(F.count(F.lit(1)).alias("edges")).join(loose.agg(F.count(F.lit(1)).alias("loose"))).join(twice.agg(F.count(F.lit(1)).alias("repeated")))


@_query("""SELECT 'Table' AS label, count(*) AS n FROM supplier UNION ALL SELECT 'Column', 3 * count(*) FROM supplier UNION ALL SELECT 'State', 2 * count(*) FROM supplier UNION ALL SELECT 'BusinessRule', count(*) FROM supplier
UNION ALL SELECT 'RuleSet', count(*) FROM supplier UNION ALL SELECT 'BlindSpot', 4""")
def graph_from_runs(spark, sf_dir):
    """The graph of the tables from written runs of the parser, the data model and the rules; the other four are absent, and so are files and gaps."""
    root, code = fresh(spark, "runs"), _tables(spark, sf_dir)
    for stage in ("parser", "data"):
        runs.write_run(spark, root, stage, st.tables_of(code, stage))
    runs.write_run(spark, root, "rules", st.tables_of(st.Artefacts(spark, root), "rules"))
    return st.graph_from_runs(st.Artefacts(spark, root)).nodes.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@_query(f"SELECT 'ACCOUNTS.BALANCE' AS column_id, count(*) AS dependents FROM customer UNION ALL SELECT 'ACCOUNTS.ID', count(*) FROM customer UNION ALL SELECT 'AUDIT.ID', count(*) FROM ({_K}) WHERE l + e > 0")
def graph_hot_columns(spark, sf_dir):
    return gr.hot_columns(_graph(spark, sf_dir))


@_query("""SELECT 'column_without_table' AS violation, 3 * count(*) AS n FROM supplier WHERE s_suppkey % 4 = 0 UNION ALL SELECT 'rule_without_source', count(*) FROM supplier WHERE s_suppkey % 5 = 0
UNION ALL SELECT 'unenforced_rule_not_shown', count(*) FROM supplier WHERE s_suppkey % 21 = 0""")
def graph_violations(spark, sf_dir):
    """A graph with faults of each kind: tables that have lost their columns' edges, rules that have lost their sources, unenforced rules no longer marked for review."""
    g = _graph(spark, sf_dir)
    number = lambda name: F.regexp_extract(name, r"^T_(\d+)$", 1).try_cast("long")
    of = lambda name, n: F.coalesce(number(name) % n == 0, F.lit(False))
    unsourced = g.rules.filter(of(F.col("object_id"), 5)).select(F.col("rule_id").alias("source"))
    edges = g.edges.filter(~((F.col("type") == "HAS_COLUMN") & of(F.col("source"), 4)))
    traced = edges.filter("type IN ('IMPLEMENTED_AT', 'ENFORCED_IN')").join(big(unsourced), "source", "left_anti")
    edges = edges.filter("type NOT IN ('IMPLEMENTED_AT', 'ENFORCED_IN')").unionByName(traced)
    rules = g.rules.withColumn("requires_sme_review", F.col("requires_sme_review") & ~of(F.col("object_id"), 7))
    return gr.violations(gr.Graph(g.nodes, edges, g.dropped, rules)).groupBy("violation").agg(F.count(F.lit(1)).alias("n"))


@_query(f"""SELECT object_id, 'AUDIT.ID' AS column_id, CAST((3 - k % 3) % 3 AS INT) AS hops FROM ({_K}) WHERE k + (3 - k % 3) % 3 IN (SELECT c_custkey FROM customer)""")
def graph_write_paths(spark, sf_dir):
    """Routines that write AUDIT.ID themselves (every third), or through one or two that they call."""
    return gr.write_paths(_graph(spark, sf_dir)).filter("column_id = 'AUDIT.ID'")


def _asked(question: str):
    def run(spark, sf_dir: str) -> DataFrame:
        found = gr.ask(_graph(spark, sf_dir), question)
        if not found["ok"]:
            raise ValueError(found["reason"])
        return found["answer"]

    return run


@_query(f"SELECT 'PROC-APP.P_' || c_custkey AS key, 'READS_COLUMN' AS type FROM customer UNION ALL SELECT 'PROC-APP.P_' || c_custkey, 'WRITES_COLUMN' FROM customer")
def ask_impact(spark, sf_dir):
    return _asked("What breaks if I change accounts.balance?")(spark, sf_dir).filter("key LIKE 'PROC%' AND NOT key LIKE '%STMT%'").select("key", "type")


@_query("SELECT 'PROC-APP.P_1.' || n AS key FROM (VALUES ('P_ID'), ('P_OUT')) t(n)")
def ask_interface(spark, sf_dir):
    return _asked("What is the calling interface of p_1?")(spark, sf_dir).select("key")


@_query("SELECT CAST(count(*) AS BIGINT) AS users FROM customer")
def ask_table_access(spark, sf_dir):
    return _asked("Which program units read or write the table accounts?")(spark, sf_dir).agg(F.countDistinct("source").alias("users"))


@_query("SELECT count(*) AS n FROM supplier WHERE s_suppkey % 3 = 0")
def ask_not_enforced(spark, sf_dir):
    return _asked("Which rules are recorded but not enforced by the database?")(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


@_query("SELECT count(*) AS n FROM supplier WHERE s_suppkey % 3 <> 2")
def ask_to_confirm(spark, sf_dir):
    return _asked("Which rules still need a person to confirm them?")(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


@_query(f"SELECT object_id AS key, CAST(4 + e + l + o AS INTEGER) AS cyclomatic FROM ({_K}) ORDER BY cyclomatic DESC, key LIMIT 10")
def ask_most_complex(spark, sf_dir):
    return _asked("Which program units are most complex?")(spark, sf_dir)


@_query("SELECT 'T_' || s_suppkey AS key FROM supplier")
def ask_untouched_tables(spark, sf_dir):
    return _asked("Which tables are never touched by any program unit?")(spark, sf_dir).select("key")


@_query("""SELECT 'DYNAMIC_SQL' AS key, CAST(0 AS BIGINT) AS places UNION ALL SELECT 'TRIGGER_SIDE_EFFECTS', 0 UNION ALL SELECT 'UNRESOLVED_CALLS', count(*) FROM customer WHERE c_custkey + 1 NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'EXTERNAL_CALLERS', count(*) FROM customer WHERE c_custkey - 1 NOT IN (SELECT c_custkey FROM customer)""")
def ask_blind_spots(spark, sf_dir):
    """What no reading shows, with the places in the facts where it may matter."""
    return _asked("What can this graph NOT see?")(spark, sf_dir).select("key", F.regexp_extract("detail", r"(\d+)$", 1).cast("long").alias("places"))


@_query(f"SELECT 'PROC-APP.P_2' AS object_id, 'ENFORCED_IN' AS type, CAST(4 + e AS BIGINT) AS rules FROM ({_K}) WHERE k = 2")
def ask_rules_for(spark, sf_dir):
    """The rules of one routine: two branches and one more, a handler and a formula."""
    return _asked("Which business rules apply to p_2?")(spark, sf_dir).groupBy(F.lit("PROC-APP.P_2").alias("object_id"), "type").agg(F.countDistinct("key").alias("rules"))


@_query(f"""SELECT 'IMPLEMENTED_AT' AS type, 'Statement' AS place, CAST(sum(4 + e) AS BIGINT) AS rules FROM ({_K}) UNION ALL SELECT 'IMPLEMENTED_AT', 'File', count(*) FROM supplier
UNION ALL SELECT 'ENFORCED_IN', 'Object', CAST(sum(4 + e) AS BIGINT) FROM ({_K}) UNION ALL SELECT 'ENFORCED_IN', 'Table', count(*) FROM supplier""")
def graph_rule_places(spark, sf_dir):
    """Where all rules live, by the edges that answer that question of one."""
    places = _graph(spark, sf_dir).edges.filter("source_label = 'BusinessRule' AND type IN ('IMPLEMENTED_AT', 'ENFORCED_IN')")
    return places.groupBy("type", F.col("target_label").alias("place")).agg(F.countDistinct("source").alias("rules"))


@_query(f"SELECT 'ACCOUNTS.BALANCE' AS target, count(*) AS users FROM customer UNION ALL SELECT 'ACCOUNTS.ID', count(*) FROM customer UNION ALL SELECT 'AUDIT.ID', count(*) FROM ({_K}) WHERE l + e > 0")
def ask_widest_columns(spark, sf_dir):
    return _asked("Which columns are used most widely?")(spark, sf_dir).select("target", "users")


@_query(f"""SELECT 'constraint_not_enforced' AS type, count(*) AS n FROM supplier WHERE s_suppkey % 3 = 0 UNION ALL SELECT 'constraint_not_validated', count(*) FROM supplier WHERE s_suppkey % 3 = 1
UNION ALL SELECT 'relationship_not_declared', count(*) FROM supplier WHERE s_suppkey + 1 IN (SELECT s_suppkey FROM supplier) UNION ALL SELECT 'unresolved_reference', count(*) FROM customer WHERE c_custkey + 1 NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'generic_handler', CAST(sum(o) AS BIGINT) FROM ({_K}) UNION ALL SELECT 'rule_to_confirm', count(*) FROM supplier WHERE s_suppkey % 3 <> 2 UNION ALL SELECT 'transaction_hazard', CAST(sum(lc) AS BIGINT) FROM ({_K})""")
def ask_open_questions(spark, sf_dir):
    """Open matters by type."""
    return _asked("What open questions remain for the business?")(spark, sf_dir).groupBy(F.col("name").alias("type")).agg(F.count(F.lit(1)).alias("n"))


# -- inventory --------------------------------------------------------------------------------------------------------------------
@_query("SELECT CAST(l_orderkey AS BIGINT) AS k, CASE WHEN r = 1 THEN 'A__00000000' ELSE 'A__00000000_' || r END AS file_id FROM (SELECT l_orderkey * 10 + l_linenumber AS l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS r FROM lineitem)")
def id_collisions(spark, sf_dir):
    """Lines of an order as files whose prints are the same: all but the first get a number."""
    rows = _read(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("k"), F.col("l_orderkey").alias("group"), F.col("l_linenumber").cast("string").alias("file"), F.lit("A__00000000").alias("file_id"))
    return inv.distinct_ids(rows, "file_id", "file", "group").select("k", "file_id")


@_query("SELECT CASE WHEN doc_id % 4 = 0 THEN 'ddl' WHEN doc_id % 4 = 3 THEN 'ddl' ELSE 'other' END AS route, count(*) AS files FROM documents GROUP BY 1")
def ddl_routing(spark, sf_dir):
    text = F.when(F.col("doc_id") % 4 == 0, "create table a (b number);").when(F.col("doc_id") % 4 == 1, "insert into a values (1);").when(F.col("doc_id") % 4 == 2, "create or replace procedure p is begin null; end;").otherwise("create or replace procedure p is begin null; end;\n/\ncreate or replace view v as select 1 from dual;")
    rows = inv.inventory(_read(spark, sf_dir, "documents").select(F.concat(F.lit("d/"), "doc_id", F.lit(".sql")).alias("file"), text.alias("text")))
    return inv.route_ddl(rows).groupBy(F.when(F.col("is_ddl"), "ddl").otherwise("other").alias("route")).agg(F.count(F.lit(1)).alias("files"))


@_query("SELECT f.feature, count(*) AS files FROM documents, (VALUES ('has_insert', 0), ('has_create_table', 1), ('has_dynamic_sql', 2), ('has_dbms_calls', 2)) f(feature, k) WHERE doc_id % 3 = f.k GROUP BY f.feature")
def feature_counts(spark, sf_dir):
    text = F.when(F.col("doc_id") % 3 == 0, "insert into a values (1);").when(F.col("doc_id") % 3 == 1, "create table a (b number);").otherwise("begin execute immediate x; dbms_output.put_line(y); end;")
    rows = inv.inventory(_read(spark, sf_dir, "documents").select(F.concat(F.lit("d/"), "doc_id", F.lit(".sql")).alias("file"), text.alias("text")))
    return inv.feature_counts(rows)


@_query("SELECT 'd/' || doc_id || '.sql' AS file FROM documents WHERE doc_id % 3 = 2")
def high_complexity_files(spark, sf_dir):
    text = F.when(F.col("doc_id") % 3 == 2, "begin execute immediate x; dbms_output.put_line(y); end;").otherwise("insert into a values (1);")
    return inv.high_complexity(inv.inventory(_read(spark, sf_dir, "documents").select(F.concat(F.lit("d/"), "doc_id", F.lit(".sql")).alias("file"), text.alias("text"))))


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
