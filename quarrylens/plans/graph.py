"""The property graph of a code base: nodes, relationships, open matters, twelve questions, and exports.

nodes(label, key, name, line, detail) and edges(type, source_label, source, target_label, target) are plain relations; a
question is a join over them, found by the words of its text. What cannot be matched exactly is refused.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import language as la
from . import code as c, rules as ru, schema as sc
from .code import Code
from .cut import big, settled, side_by_side

# The graph's names of control-flow edges, and what no reading of source text can show.
FLOW = {"SEQUENCE": "FOLLOWS", "BRANCH_ENTRY": "BRANCHES_TO", "EXCEPTION_EDGE": "ON_ERROR_REACHES", "LOOP_BACK_EDGE": "LOOPS_BACK_TO"}
BLIND_SPOTS = {
    "DYNAMIC_SQL": "statements put together at run time",
    "EXTERNAL_CALLERS": "callers outside the code base",
    "UNRESOLVED_CALLS": "routines that are called but not in the code base",
    "TRIGGER_SIDE_EFFECTS": "changes that triggers make on their own",
}
HOT_DEPENDENTS = 2


def _null() -> Column:
    return F.lit(None).cast("string")


def gaps(code: Code, rules_: DataFrame) -> DataFrame:
    """Open matters, one row each, (gap_id, type, severity, subject, line, message); the id is the print of type and subject, so reruns agree."""
    cols, cons, s = sc.columns(code), sc.constraints(code), code.rows("statements")
    hazard = c.transactions(code).select("object_id", F.explode("hazards").alias("h")).filter("h.severity = 'high'")

    def rows(df: DataFrame, kind: str, severity: str, subject: Column, line: Column | None, message: Column | str) -> DataFrame:
        return df.select(F.lit(kind).alias("type"), F.lit(severity).alias("severity"), subject.alias("subject"), (line if line is not None else F.lit(None)).cast("int").alias("line"), (F.lit(message) if isinstance(message, str) else message).alias("message"))

    parts = [
        rows(cons.filter("NOT is_enforced"), "constraint_not_enforced", "high", F.concat_ws(".", "table_name", "name"), F.col("line"), "the database does not hold this constraint"),
        rows(cons.filter("is_enforced AND validated = 'NOT_VALIDATED'"), "constraint_not_validated", "low", F.concat_ws(".", "table_name", "name"), F.col("line"), "older rows may break this constraint"),
        rows(cols.filter("enum_source = 'comment_only'"), "enum_in_comment_only", "medium", F.concat_ws(".", "table_name", "name"), F.col("line"), "values are listed in a comment only; data may differ"),
        rows(sc.inferred_relationships(code), "relationship_not_declared", "medium", F.concat_ws(".", "from_table", "from_column"), None, F.concat(F.lit("looks like a reference to "), "to_table")),
        rows(hazard, "transaction_hazard", "high", F.concat_ws(":", "object_id", "h.hazard"), None, F.col("h.explanation")),
        rows(c.calls(code).filter("status = 'unresolved_reference'"), "unresolved_reference", "medium", F.concat_ws(":", "statement_id", "call_target"), F.col("line"), "the called routine is not in the code base"),
        rows(s.filter("requires_manual_review"), "dynamic_statement", "high", F.col("statement_id"), F.col("line"), "the statement is put together at run time"),
        rows(sc.type_references(code).filter("NOT resolved"), "type_not_resolved", "medium", F.concat_ws(":", "object_id", "reference"), None, "the referenced column is not in the data model"),
        rows(sc.unknown_tables(code), "table_not_known", "medium", F.concat_ws(":", "statement_id", "table_name"), F.col("line"), "the table is not in the data model"),
        rows(ru.error_catalogue(code, rules_), "generic_handler", "low", F.col("statement_id"), F.col("line"), "errors are passed on without a stated outcome"),
        rows(rules_.filter("requires_sme_review"), "rule_to_confirm", "low", F.col("rule_id"), F.col("line"), F.col("name")),
        rows(code.rows("issues"), "source_not_read", "high", F.concat_ws(":", "file_id", "type", "line"), F.col("line"), F.col("message")),
        rows(c.loops(code).filter("warns"), "loop_without_end", "critical", F.col("statement_id"), F.col("line"), "no way out of the loop was found"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.dropDuplicates(["type", "subject"]).withColumn("gap_id", F.concat(F.lit("GAP-"), F.upper(F.substring(F.sha2(F.concat_ws("|", "type", "subject"), 256), 1, 10))))


@dataclass
class Graph:
    nodes: DataFrame
    edges: DataFrame
    dropped: DataFrame
    rules: DataFrame

    def out(self, label: str, key: str) -> DataFrame:
        return self.edges.filter((F.col("source_label") == label) & (F.col("source") == key))

    def into(self, label: str, key: str) -> DataFrame:
        return self.edges.filter((F.col("target_label") == label) & (F.col("target") == key))


def _node(df: DataFrame, label: str, key: Column, name: Column, line: Column | None = None, detail: Column | None = None) -> DataFrame:
    return df.select(F.lit(label).alias("label"), key.alias("key"), name.cast("string").alias("name"), (line if line is not None else F.lit(None)).cast("int").alias("line"), (detail if detail is not None else _null()).cast("string").alias("detail"))


def _edge(df: DataFrame, kind: str | Column, a_label: str, a: Column, b_label: str, b: Column) -> DataFrame:
    return df.select((F.lit(kind) if isinstance(kind, str) else kind).alias("type"), F.lit(a_label).alias("source_label"), a.alias("source"), F.lit(b_label).alias("target_label"), b.alias("target"))


def blind_spots(code: Code) -> DataFrame:
    """(k, d, n): what no reading shows, with the number of places in the facts where it may matter."""
    places = {
        "DYNAMIC_SQL": code.rows("statements").filter("requires_manual_review"), "EXTERNAL_CALLERS": c.no_internal_callers(code),
        "UNRESOLVED_CALLS": c.calls(code).filter("status = 'unresolved_reference'"), "TRIGGER_SIDE_EFFECTS": code.rows("objects").filter("type = 'TRIGGER'"),
    }
    counts = [places[k].agg(F.lit(k).alias("k"), F.lit(d).alias("d"), F.count(F.lit(1)).alias("n")) for k, d in BLIND_SPOTS.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


@dataclass
class Parts:
    """What a graph has besides facts: files (file_id, file), rules with their modality, open matters, complexities and, if known, moves between states."""

    files: DataFrame
    rules: DataFrame
    gaps: DataFrame
    complexity: DataFrame
    moves: DataFrame | None = None

    @classmethod
    def of(cls, code: Code) -> Parts:
        code.rows("statements")
        shared = (ru.mined, sc.columns, c.calls, sc.column_access, c.control_flow, c.slices)
        side_by_side(*[lambda f=f: f(code) for f in shared])
        rules = ru.modality(ru.rules(code))
        return cls(code.facts.select("file_id", "file"), rules, settled(gaps(code, rules)), c.complexity(code).select("file_id", "object_id", "cyclomatic"))


def build(code: Code, parts: Parts | None = None) -> Graph:
    """All nodes and relationships; a relationship without both ends is taken out and counted in `dropped`."""
    col, cat = F.col, F.concat_ws
    parts = parts or Parts.of(code)
    r, found, metrics = parts.rules, parts.gaps, parts.complexity
    s, objects = code.rows("statements"), code.rows("objects")
    states = sc.columns(code).filter("enum_source = 'check_constraint'").select("table_name", "name", F.explode("enum_values").alias("v"))
    column = cat(".", "table_name", "name")
    nodes = [
        _node(parts.files, "File", col("file_id"), col("file")),
        _node(objects.join(big(metrics), ["file_id", "object_id"], "left"), "Object", col("object_id"), F.coalesce("member", "name"), col("line"), col("cyclomatic")),
        _node(s, "Statement", col("statement_id"), col("type"), col("line"), col("text")),
        _node(code.rows("parameters"), "Parameter", cat(".", "object_id", "name"), col("name"), col("position"), cat(" ", "mode", "type")),
        _node(code.rows("variables"), "Variable", cat(".", "object_id", "name"), col("name")),
        _node(code.rows("tables"), "Table", col("table_name"), col("table_name"), col("line")),
        _node(code.rows("columns"), "Column", column, col("name"), col("line"), col("type")),
        _node(r, "BusinessRule", col("rule_id"), col("name"), col("line"), F.to_json(F.struct("kind", "confidence", "requires_sme_review", "is_enforced", "formal_statement"))),
        _node(ru.rule_sets(r), "RuleSet", cat(":", F.lit("RULES"), "object_id"), col("object_id")),
        _node(states, "State", cat("=", column, "v"), col("v")),
        _node(code.rows("sequences"), "Sequence", col("sequence_name"), col("sequence_name"), col("line")),
        _node(code.rows("indexes"), "Index", col("index_name"), col("index_name"), col("line")),
        _node(found, "Gap", col("gap_id"), col("type"), col("line"), cat(": ", "severity", "subject", "message")),
        _node(blind_spots(code), "BlindSpot", col("k"), col("k"), None, cat(": ", "d", "n")),
    ]
    used = sc.column_access(code)
    mode = F.when(col("mode") == "READ", "READS_COLUMN").otherwise("WRITES_COLUMN")
    flow = c.control_flow(code).filter("source <> '*'")
    names = F.create_map(*[F.lit(x) for kv in FLOW.items() for x in kv])
    cut = c.slices(code).select("file_id", "object_id", "variable", F.explode("determined_by").alias("seq")).withColumn("statement_id", c.statement_id(col("seq")))
    parameters = code.rows("parameters").select("file_id", "object_id", col("name").alias("variable"), F.lit(True).alias("p")).distinct()
    cut = cut.join(big(parameters), ["file_id", "object_id", "variable"], "left").withColumn("of_parameter", F.coalesce("p", F.lit(False)))
    edges = [
        _edge(objects, "DEFINES", "File", col("file_id"), "Object", col("object_id")),
        _edge(s, "CONTAINS_STATEMENT", "Object", col("object_id"), "Statement", col("statement_id")),
        _edge(code.rows("parameters"), "HAS_PARAMETER", "Object", col("object_id"), "Parameter", cat(".", "object_id", "name")),
        _edge(code.rows("columns"), "HAS_COLUMN", "Table", col("table_name"), "Column", column),
        _edge(c.calls(code).filter("status = 'resolved'"), "CALLS", "Object", col("object_id"), "Object", col("call_target_object_id")),
        _edge(used, mode, "Statement", col("statement_id"), "Column", column),
        _edge(used, mode, "Object", col("object_id"), "Column", column),
        _edge(flow, F.element_at(names, col("type")), "Statement", col("source"), "Statement", col("target")),
        _edge(cut.filter("of_parameter"), "DETERMINES", "Statement", col("statement_id"), "Parameter", cat(".", "object_id", "variable")),
        _edge(cut.filter("NOT of_parameter"), "DETERMINES", "Statement", col("statement_id"), "Variable", cat(".", "object_id", "variable")),
        _edge(r.filter("statement_id IS NOT NULL"), "IMPLEMENTED_AT", "BusinessRule", col("rule_id"), "Statement", col("statement_id")),
        _edge(r.filter("kind LIKE 'ddl%'"), "IMPLEMENTED_AT", "BusinessRule", col("rule_id"), "File", col("file_id")),
        _edge(r.filter("NOT kind LIKE 'ddl%'"), "ENFORCED_IN", "BusinessRule", col("rule_id"), "Object", col("object_id")),
        _edge(r.filter("kind LIKE 'ddl%'"), "ENFORCED_IN", "BusinessRule", col("rule_id"), "Table", col("object_id")),
        _edge(r.filter("kind LIKE 'ddl%'"), "CONSTRAINS", "BusinessRule", col("rule_id"), "Column", col("subject")),
        _edge(r, "BELONGS_TO", "BusinessRule", col("rule_id"), "RuleSet", cat(":", F.lit("RULES"), "object_id")),
        _edge(states, "HAS_STATE", "Column", column, "State", cat("=", column, "v")),
        _edge(code.rows("constraints").filter("kind = 'FOREIGN KEY'"), "REFERENCES", "Table", col("table_name"), "Table", col("references_table")),
        _edge(sc.inferred_relationships(code), "MAY_REFERENCE", "Table", col("from_table"), "Table", col("to_table")),
        _edge(code.rows("indexes").select("index_name", F.explode("columns").alias("x"), "table_name"), "INDEXES", "Index", col("index_name"), "Column", cat(".", "table_name", "x")),
        _edge(sc.sequence_usages(code), "USES_SEQUENCE", "Statement", col("statement_id"), "Sequence", col("sequence_name")),
        _edge(found.filter("type = 'rule_to_confirm'"), "CONCERNS", "Gap", col("gap_id"), "BusinessRule", col("subject")),
    ]
    if parts.moves is not None:
        edges.append(_edge(parts.moves.filter("origin IS NOT NULL AND target IS NOT NULL"), "MOVES_TO", "State", cat("=", column, "origin"), "State", cat("=", column, "target")))
    all_nodes, all_edges = nodes[0], edges[0]
    for n in nodes[1:]:
        all_nodes = all_nodes.unionByName(n)
    for e in edges[1:]:
        all_edges = all_edges.unionByName(e)
    all_nodes, all_edges = side_by_side(lambda: settled(all_nodes.dropDuplicates(["label", "key"])), lambda: settled(all_edges.dropDuplicates()))
    ends = all_nodes.select("label", "key")
    kept = all_edges.join(big(ends.toDF("source_label", "source")), ["source_label", "source"], "left_semi").join(big(ends.toDF("target_label", "target")), ["target_label", "target"], "left_semi")
    kept = settled(kept.select("type", "source_label", "source", "target_label", "target"))
    dropped = all_edges.groupBy("type").agg(F.count(F.lit(1)).alias("n")).join(kept.groupBy("type").agg(F.count(F.lit(1)).alias("k")), "type", "left").select("type", (F.col("n") - F.coalesce("k", F.lit(0))).alias("dropped"))
    return Graph(all_nodes, kept, dropped, r)


# -- derived views and checks ------------------------------------------------------------------------------------------------
def hot_columns(g: Graph) -> DataFrame:
    return g.edges.filter("type IN ('READS_COLUMN', 'WRITES_COLUMN') AND source_label = 'Object'").groupBy(F.col("target").alias("column_id")).agg(F.countDistinct("source").alias("dependents")).filter(F.col("dependents") > HOT_DEPENDENTS)


def rule_statements(g: Graph) -> DataFrame:
    return g.edges.filter("type = 'IMPLEMENTED_AT' AND target_label = 'Statement'").select(F.col("target").alias("statement_id")).distinct()


def write_paths(g: Graph, hops: int = 10) -> DataFrame:
    """(object_id, column_id, hops): columns an object writes itself or through calls, with the fewest calls. Each step goes on from the pairs that the step before found, and a pair is kept at its first."""
    calls = g.edges.filter("type = 'CALLS' AND source <> target").select(F.col("source").alias("object_id"), F.col("target").alias("next"))
    fresh_ = settled(g.edges.filter("type = 'WRITES_COLUMN' AND source_label = 'Object'").select(F.col("source").alias("object_id"), F.col("target").alias("column_id"), F.lit(0).alias("hops")).distinct())
    reach = fresh_
    for hop in range(1, hops + 1):
        further = calls.join(big(fresh_.select(F.col("object_id").alias("next"), "column_id")), "next").select("object_id", "column_id").distinct()
        fresh_ = settled(further.join(big(reach.select("object_id", "column_id")), ["object_id", "column_id"], "left_anti").withColumn("hops", F.lit(hop)))
        if fresh_.isEmpty():
            break
        reach = reach.unionByName(fresh_)
    return reach


def violations(g: Graph) -> DataFrame:
    """Rows that should not be there: rules without a source, columns without a table, unenforced rules not marked for review."""
    rules_ = g.nodes.filter("label = 'BusinessRule'")
    traced = g.edges.filter("type IN ('IMPLEMENTED_AT', 'ENFORCED_IN')").select(F.col("source").alias("key"))
    owned = g.edges.filter("type = 'HAS_COLUMN'").select(F.col("target").alias("key"))
    lost = rules_.join(big(traced), "key", "left_anti").select("key", F.lit("rule_without_source").alias("violation"))
    orphan = g.nodes.filter("label = 'Column'").join(big(owned), "key", "left_anti").select("key", F.lit("column_without_table").alias("violation"))
    hidden = g.rules.filter("is_enforced = false AND NOT requires_sme_review").select(F.col("rule_id").alias("key"), F.lit("unenforced_rule_not_shown").alias("violation"))
    return lost.unionByName(orphan).unionByName(hidden)


# -- questions ---------------------------------------------------------------------------------------------------------------
def _at(g: Graph, edges: DataFrame, side: str) -> DataFrame:
    other = g.nodes.select(F.col("label").alias(f"{side}_label"), F.col("key").alias(side), "name", "line", "detail")
    return edges.join(big(other), [f"{side}_label", side]).select("type", F.col(side).alias("key"), "name", F.concat(F.lit("line "), F.col("line").cast("string")).alias("at"), "detail")


def _listed(g: Graph, label: str, where: str = "true") -> DataFrame:
    return g.nodes.filter((F.col("label") == label) & F.expr(where)).select("key", "name", "line", "detail")


def _ranked_objects(g: Graph) -> DataFrame:
    return _listed(g, "Object").select("key", F.col("detail").cast("int").alias("cyclomatic")).orderBy(F.desc_nulls_last("cyclomatic"), "key").limit(10)


def _touched(g: Graph) -> DataFrame:
    return g.edges.filter("type IN ('READS_COLUMN', 'WRITES_COLUMN')").select(F.substring_index("target", ".", 1).alias("key")).distinct()


def _table_users(g: Graph, table: str) -> DataFrame:
    used = g.edges.filter("type IN ('READS_COLUMN', 'WRITES_COLUMN') AND source_label = 'Object'").filter(F.substring_index("target", ".", 1) == table)
    return used.select("source", "type").distinct()


# The texts of the twelve questions are the documented interface.
_RULE_TYPES = ("ENFORCED_IN", "CONSTRAINS", "IMPLEMENTED_AT")
#: (name, question, words that call for it, what it needs, how it is answered, the same in the graph query language)
INTENTS = (
    ("impact_of_column", "What breaks if I change a given column?", r"break|impact|affect|depends? on|\bchang", "Column", lambda g, k: _at(g, g.into("Column", k), "source"), "MATCH (x)-[r]->(c:Column {key: $key}) RETURN type(r), x"),
    ("rules_for", "Which business rules apply to a program unit, table or column?", r"rules?\b.*\bappl|rules? (for|of|on)\b", "Object|Table|Column", lambda g, k: _at(g, g.edges.filter(F.col("type").isin(*_RULE_TYPES) & (F.col("target") == k)), "source"), "MATCH (r:BusinessRule)-[]->(x {key: $key}) RETURN r"),
    ("rule_location", "Where does a given rule live in the source?", r"where\b.*\b(rule|br-\d+)|implemented", "BusinessRule", lambda g, k: _at(g, g.out("BusinessRule", k).filter("type IN ('IMPLEMENTED_AT', 'ENFORCED_IN')"), "target"), "MATCH (:BusinessRule {key: $key})-[:IMPLEMENTED_AT]->(s) RETURN s"),
    ("table_access", "Which program units read or write a given table?", r"\b(reads?|writes?|updates?|touches|uses)\b.*\btable|who (reads|writes)", "Table", _table_users, "MATCH (o:Object)-[r]->(:Column)<-[:HAS_COLUMN]-(:Table {key: $key}) RETURN DISTINCT o, type(r)"),
    ("interface", "What is the calling interface of a program unit?", r"\bcall(ing)?\b|interface|parameters?", "Object", lambda g, k: _at(g, g.out("Object", k).filter("type = 'HAS_PARAMETER'"), "target").orderBy(F.regexp_extract("at", r"(\d+)", 1).cast("int")), "MATCH (:Object {key: $key})-[:HAS_PARAMETER]->(p) RETURN p ORDER BY p.line"),
    ("rules_to_confirm", "Which rules still need a person to confirm them?", r"confirm|review", None, lambda g, _: g.rules.filter("requires_sme_review").select("rule_id", "name", "line"), "MATCH (r:BusinessRule {requires_sme_review: true}) RETURN r"),
    ("rules_not_enforced", "Which rules are recorded but not enforced by the database?", r"not enforced|unenforced|disabled", None, lambda g, _: g.rules.filter("is_enforced = false").select("rule_id", "name", "line"), "MATCH (r:BusinessRule {is_enforced: false}) RETURN r"),
    ("most_complex", "Which program units are most complex?", r"complex", None, lambda g, _: _ranked_objects(g), "MATCH (o:Object) RETURN o ORDER BY o.cyclomatic DESC LIMIT 10"),
    ("widest_columns", "Which columns are used most widely?", r"columns?\b.*\b(widely|most used|used most)|widely", None, lambda g, _: g.edges.filter("type IN ('READS_COLUMN', 'WRITES_COLUMN') AND source_label = 'Object'").groupBy("target").agg(F.countDistinct("source").alias("users")).orderBy(F.desc("users"), "target").limit(10), "MATCH (o:Object)-[:READS_COLUMN|WRITES_COLUMN]->(c) RETURN c, count(DISTINCT o) AS n ORDER BY n DESC LIMIT 10"),
    ("untouched_tables", "Which tables are never touched by any program unit?", r"tables?\b.*\b(never|unused|not used)", None, lambda g, _: _listed(g, "Table").join(big(_touched(g)), "key", "left_anti"), "MATCH (t:Table) WHERE NOT (t)-[:HAS_COLUMN]->()<--(:Object) RETURN t"),
    ("open_questions", "What open questions remain for the business?", r"open (questions?|matters?)|gaps?\b", None, lambda g, _: _listed(g, "Gap"), "MATCH (g:Gap) RETURN g"),
    ("blind_spots", "What can this graph NOT see?", r"\bnot see|blind|cannot see", None, lambda g, _: _listed(g, "BlindSpot"), "MATCH (b:BlindSpot) RETURN b"),
)


def resolve_entity(g: Graph, question: str) -> tuple[str | None, str | None]:
    """(label, key) of what the question names: a rule's id, table.column, the longest exact name or title of several words, a bare column; else nothing. Only the question's own words are looked up."""
    upper = question.upper()
    rule = re.search(r"\bBR-\d{3,}\b", upper)
    dotted = re.findall(r"\b\w+\.\w+\b", upper)
    words = re.findall(r"[\w$#]+", upper)
    wanted = {*words, *dotted, *({rule.group()} if rule else ())}
    titles = [" ".join(words[i : i + k]) for k in range(2, 7) for i in range(len(words) - k + 1)] or [""]
    if not wanted:
        return None, None
    n = g.nodes.filter("label IN ('BusinessRule', 'Column', 'Object', 'Table', 'Sequence', 'Index')")
    title = F.upper(F.when(F.col("label") == "Object", la.object_title(F.col("key"))).when(F.col("label") == "Table", la.humanise(F.col("key"))))
    hits = n.withColumn("title", title).filter(F.upper("key").isin(*wanted) | F.upper("name").isin(*wanted) | F.col("title").isin(*titles))
    hits = hits.withColumn("matched", F.when(F.upper("key").isin(*wanted) | F.upper("name").isin(*wanted), F.length("name")).otherwise(F.length("title")))
    rank = F.when((F.col("label") == "BusinessRule") & (F.lit(rule.group() if rule else "") == F.col("key")), 1).when((F.col("label") == "Column") & F.upper("key").isin(*(dotted or [""])), 2).when(F.col("label").isin("Object", "Table", "Sequence", "Index"), 3).when((F.col("label") == "Column") & ~F.lit(bool(dotted)), 4)
    best = hits.withColumn("rank", rank).filter("rank IS NOT NULL").orderBy("rank", F.desc("matched"), "label", "key").limit(1).collect()
    return (best[0]["label"], best[0]["key"]) if best else (None, None)


NO_FIT = "the question fits none of the twelve"


def fitting(question: str) -> list[tuple]:
    """The questions whose words this one has."""
    return [i for i in INTENTS if re.search(i[2], question, re.I)]


def ask(g: Graph, question: str) -> dict:
    """{ok, intent, subject, answer (a DataFrame), query} or {ok: False, reason, suggestions}; never a guess."""
    fits = fitting(question)
    if not fits:
        return {"ok": False, "reason": NO_FIT, "suggestions": [i[1] for i in INTENTS]}
    label, key = resolve_entity(g, question)
    fits.sort(key=lambda i: (not (label is not None and i[3] is not None and label in i[3].split("|")), INTENTS.index(i)))
    name, text, _, needs, answer, query = fits[0]
    if needs and (label is None or label not in needs.split("|")):
        free = [i for i in fits if i[3] is None]
        if not free:
            return {"ok": False, "intent": name, "reason": f"could not identify which {needs.replace('|', ' or ')} is meant: {text}", "suggestions": [i[1] for i in INTENTS]}
        name, text, _, needs, answer, query = free[0]
    return {"ok": True, "intent": name, "subject": key if needs else None, "answer": answer(g, key), "query": query}


# -- exports -----------------------------------------------------------------------------------------------------------------
def write_tables(g: Graph, root: str) -> None:
    """nodes/label=.../*.csv and rels/type=.../*.csv below root; a label or type with many rows is written by many tasks."""
    g.nodes.write.partitionBy("label").option("header", True).option("escape", '"').option("multiLine", True).mode("overwrite").csv(f"{root}/nodes")
    g.edges.write.partitionBy("type").option("header", True).option("escape", '"').mode("overwrite").csv(f"{root}/rels")


def load_script(g: Graph) -> DataFrame:
    """Lines (step, line) that load the graph: constraints, then nodes, then relationships; merging only, so a rerun adds nothing."""
    quote = lambda x: F.concat(F.lit("'"), F.regexp_replace(F.regexp_replace(F.coalesce(x, F.lit("")), r"\\", r"\\\\"), "'", r"\\'"), F.lit("'"))
    first = g.nodes.select("label").distinct().select(F.lit(0).alias("step"), F.concat(F.lit("CREATE CONSTRAINT IF NOT EXISTS FOR (n:"), "label", F.lit(") REQUIRE n.key IS UNIQUE;")).alias("line"))
    nodes = g.nodes.select(F.lit(1).alias("step"), F.concat(F.lit("MERGE (n:"), "label", F.lit(" {key: "), quote(F.col("key")), F.lit("}) SET n.name = "), quote(F.col("name")), F.lit(";")).alias("line"))
    edges = g.edges.select(F.lit(2).alias("step"), F.concat(F.lit("MATCH (a:"), "source_label", F.lit(" {key: "), quote(F.col("source")), F.lit("}), (b:"), "target_label", F.lit(" {key: "), quote(F.col("target")), F.lit("}) MERGE (a)-[:"), "type", F.lit("]->(b);")).alias("line"))
    return first.unionByName(nodes).unionByName(edges).orderBy("step", "line")
