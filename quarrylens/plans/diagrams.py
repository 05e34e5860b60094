"""Figures of a code base: process flows, states and data flow, first as relations of nodes and edges, then as text.

Every step groups or windows on one object, whose source text bounds the group; only the data-flow map covers the whole, one line
for each object and table pair.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import language as la
from . import code as c, figure_check, schema as sc
from .code import DML, Code
from .cut import big, settled

#: Fixed value: the nodes a process flow may have before straight runs are merged.
NODE_BUDGET = 40
PROTECTED = ("DECISION", "LOOP", "ERROR", "TERMINAL", "GROUP")
_KEY = ["file_id", "object_id"]
_OPEN = {"DECISION": '{"', "LOOP": '[/"', "ERROR": '[["', "TERMINAL": '(["', "DATA": '[("', "GROUP": '("', "PROCESS": '["'}
_CLOSE = {"DECISION": '"}', "LOOP": '"/]', "ERROR": '"]]', "TERMINAL": '"])', "DATA": '")]', "GROUP": '")', "PROCESS": '"]'}


def _text(value: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(value, '"', "#quot;"), r"[\s|]+", " ")


def kind_of(statement_type: Column) -> Column:
    return (
        F.when(statement_type.isin("IF", "CASE"), "DECISION").when(statement_type == "LOOP", "LOOP").when(statement_type == "EXCEPTION_HANDLER", "ERROR").when(statement_type.isin("RAISE", "RETURN", "EXIT"), "TERMINAL")
        .when(statement_type.isin(*DML, "SELECT_INTO"), "DATA").when(statement_type == "BLOCK", "GROUP").otherwise("PROCESS")
    )


def rules_in_span(spans: DataFrame, rules: DataFrame) -> DataFrame:
    """The rule of each span (key columns, `id`, `first`, `last`) that stands at its first line, else the earliest inside it."""
    r = rules.filter("line IS NOT NULL AND NOT kind LIKE 'ddl%'").select(*_KEY, "rule_id", "condition", F.col("line").alias("at"), "signal_strength")
    near = spans.join(big(r), _KEY).filter("at BETWEEN first AND last")
    return near.groupBy("id").agg(F.min(F.struct((F.col("at") != F.col("first")).alias("later"), "at", (-F.col("signal_strength")).alias("weak"), "rule_id", "condition")).alias("r")).select("id", "r.rule_id", "r.condition")


def _rules_of_objects(rules: DataFrame) -> DataFrame:
    """A row for each object with its rules, which its source text bounds."""
    usual = F.col("kind").isin("conditional_branch", "named_exception", "case_branch")
    r = rules.filter("line IS NOT NULL AND NOT kind LIKE 'ddl%'").select(*_KEY, F.struct(F.col("line").alias("at"), (~usual).alias("odd"), (-F.col("signal_strength")).alias("weak"), "rule_id", "condition").alias("r"))
    return r.groupBy(*_KEY).agg(F.collect_list("r").alias("rules"))


def _plain(code: Code) -> DataFrame:
    """Statements as nodes without words."""
    return code.rows("statements").select(*_KEY, "statement_id", "seq", "parent", "scope", "line", "end_line", kind_of(F.col("type")).alias("kind"))


def labelled(code: Code, rules: DataFrame) -> DataFrame:
    """Each statement as a node: kind, label, rule and tier (1 a rule's condition, 2 what the statement says, 3 its line), the name of the way into its scope and the rule at the head of its arm. Only decisions take a rule's words.

    Each step's columns are named before the next step uses them, so that no text is worked out twice.
    """
    s = code.rows("statements").withColumn("node_kind", kind_of(F.col("type"))).withColumn("branch", F.when(F.col("type") == "EXCEPTION_HANDLER", c.handler_label(F.col("handler_for"))).otherwise(c.entry_label(F.col("scope"))))
    ask = lambda x: F.concat(x, F.lit("?"))
    table = F.upper(F.coalesce(F.try_element_at(F.filter("access", lambda a: a["crud"] != "R"), F.lit(1))["table_name"], F.try_element_at("access", F.lit(1))["table_name"]))
    verb = F.when(F.col("type") == "SELECT_INTO", "Read").otherwise(F.initcap("type"))
    # One expression for each way of wording, over what it words: a condition, or an identifier.
    turn = F.when(F.col("node_kind") == "DECISION", F.col("condition")).when(F.col("type") == "LOOP", F.regexp_extract("text", r"(?is)^\s*(?:FOR|WHILE)\s+(.*?)\s+LOOP\b", 1))
    name = F.when(F.col("type") == "CALL", la.title_part(F.col("call_target"))).when(F.col("type") == "ASSIGNMENT", F.try_element_at("targets", F.lit(1))).when(F.col("type") == "RAISE", F.regexp_extract("text", r"(?i)^RAISE\s+([\w.]+)", 1))
    s = s.withColumns({"turn": turn, "thing": name}).withColumn("turn", la.short_condition(F.col("turn"))).withColumn("thing", la.humanise(F.col("thing")))
    said = (
        F.when(F.col("node_kind") == "DECISION", ask(F.col("turn"))).when(F.col("type") == "EXCEPTION_HANDLER", F.concat(F.lit("On error: "), F.array_join("handler_for", " or "))).when(F.col("node_kind") == "DATA", F.concat_ws(" ", verb, table))
        .when(F.col("type") == "CALL", F.concat(F.lit("Call "), "thing")).when(F.col("type") == "ASSIGNMENT", F.concat(F.lit("Set "), "thing")).when(F.col("type") == "LOOP", F.concat(F.lit("Repeat: "), "turn"))
        .when(F.col("type") == "RAISE", F.trim(F.concat(F.lit("Raise "), "thing"))).when(F.col("type").isin("COMMIT", "ROLLBACK", "SAVEPOINT", "RETURN", "EXIT"), F.initcap("type"))
    )
    s = s.select(*_KEY, "statement_id", "seq", "parent", "scope", "line", "end_line", F.col("node_kind").alias("kind"), "branch", "arm_line", said.alias("said"))
    s = s.withColumn("said", F.when((F.trim("said") != "") & (F.col("said") != "Repeat: "), F.col("said"))).join(big(_rules_of_objects(rules)), _KEY, "left")
    decision = F.col("kind") == "DECISION"
    inside = F.filter("rules", lambda r: r["at"].between(F.col("line"), F.col("end_line")))
    first = F.array_min(F.transform(inside, lambda r: F.struct((r["at"] != F.col("line")).alias("later"), r["at"], r["weak"], r["rule_id"].alias("rule_id"), r["condition"].alias("condition"))))
    of_arm = F.array_min(F.transform(F.filter("rules", lambda r: r["at"] == F.col("arm_line")), lambda r: F.struct(r["odd"], r["weak"], r["rule_id"].alias("rule_id"))))["rule_id"]
    s = s.withColumns({"r": F.when(decision, first), "arm_rule": F.when(F.col("arm_line").isNotNull(), of_arm)}).drop("rules")
    s = s.withColumn("ruled", ask(la.short_condition(F.col("r.condition"))))
    fallback = F.concat(F.when(decision, "Decision").otherwise("Step"), F.lit(" (line "), F.col("line").cast("string"), F.lit(")"))
    label = F.regexp_replace(F.coalesce("ruled", "said", fallback), la.INTERNAL, "")
    tier = F.when(F.col("ruled").isNotNull(), 1).when(F.col("said").isNotNull(), 2).otherwise(3)
    return s.select(*_KEY, "statement_id", "seq", "parent", "scope", "line", "end_line", "kind", label.alias("label"), F.col("r.rule_id").alias("rule_id"), tier.alias("tier"), "branch", "arm_rule")


def collapse_runs(nodes: DataFrame, budget: int = NODE_BUDGET) -> DataFrame:
    """nodes with `head`, the statement that stands for each: itself, or, in an object over the budget, the first of its unbroken straight run of siblings."""
    inside = Window.partitionBy(*_KEY, "parent", "scope").orderBy("seq")
    firm = F.col("kind").isin(*PROTECTED)
    total = F.count(F.lit(1)).over(Window.partitionBy(*_KEY))
    reserved = 1 + F.max((F.col("kind") == "ERROR").cast("int")).over(Window.partitionBy(*_KEY))
    cut = nodes.withColumn("over", total + reserved > budget).withColumn("run", F.sum(firm.cast("int")).over(inside))
    first = F.first("statement_id").over(Window.partitionBy(*_KEY, "parent", "scope", "run", firm).orderBy("seq"))
    return cut.withColumn("head", F.when(F.col("over") & ~firm, first).otherwise(F.col("statement_id"))).drop("run")


def branch_label(branch: Column) -> Column:
    """`WHEN(NO_DATA_FOUND)` -> NO_DATA_FOUND; the reader's own names for blocks are hidden."""
    bare = F.regexp_replace(branch, r"^WHEN\((.*)\)$", "$1")
    return F.when(branch.isNull() | (branch == "block") | branch.rlike(la.INTERNAL), "").otherwise(bare)


class Flows:
    """The process flow of every object, each table made when it is asked for: nodes(file_id, object_id, node, kind, label, rule_id, tier, line, members), edges(file_id, object_id, source, target, type, label, rule_id), report(file_id, object_id, nodes, statements, collapsed, oversize)."""

    def __init__(self, code: Code, rules: DataFrame, budget: int):
        self.code, self.rules, self.budget = code, rules, budget

    @cached_property
    def made(self) -> DataFrame:
        """A row for each node that stands for statements, with its number, those of its parent and of the node before it. One shuffle by object serves all steps."""
        marked = collapse_runs(labelled(self.code, self.rules), self.budget)
        own = marked.groupBy(*_KEY, F.col("head").alias("statement_id")).agg(F.min(F.struct("seq", "kind", "label", "rule_id", "tier", "line", "parent", "scope", "branch", "arm_rule")).alias("n"), F.max("end_line").alias("end_line"), F.count(F.lit(1)).cast("int").alias("members"))
        merged = F.col("members") > 1
        run = F.concat(F.col("members").cast("string"), F.lit(" steps (lines "), F.col("n.line").cast("string"), F.lit(" to "), F.col("end_line").cast("string"), F.lit(")"))
        own = own.select(*_KEY, "statement_id", "members", F.when(merged, run).otherwise(F.col("n.label")).alias("label"), F.when(merged, 2).otherwise(F.col("n.tier")).alias("tier"), *[F.col(f"n.{x}").alias(x) for x in ("seq", "kind", "rule_id", "line", "parent", "scope", "branch", "arm_rule")])
        error = F.col("kind") == "ERROR"
        place = F.row_number().over(Window.partitionBy(*_KEY).orderBy("line", "seq", "statement_id"))
        own = own.withColumn("caught", F.max(error).over(Window.partitionBy(*_KEY))).withColumn("place", place).withColumn("number", F.col("place") + 1 + F.col("caught").cast("int"))
        beside = Window.partitionBy(*_KEY, "parent", "scope", error).orderBy("seq")
        own = own.withColumn("before", F.lag("number").over(beside)).withColumn("closes", F.lead("number").over(beside).isNull())
        # A node that holds others is a member of its own family too, where they learn its number.
        family = F.when(F.col("kind").isin("DECISION", "LOOP", "ERROR", "GROUP"), F.array(F.struct(F.col("parent").alias("of"), F.lit(False).alias("head")), F.struct(F.col("seq").alias("of"), F.lit(True).alias("head")))).otherwise(F.array(F.struct(F.col("parent").alias("of"), F.lit(False).alias("head"))))
        own = own.withColumn("family", F.explode(family)).withColumn("above", F.max(F.when(F.col("family.head"), F.col("number"))).over(Window.partitionBy(*_KEY, "family.of")))
        return settled(own.filter("NOT family.head").drop("family"))

    @cached_property
    def nodes(self) -> DataFrame:
        cols = (*_KEY, "statement_id", "kind", "label", "rule_id", "tier", "line", "members", "node")
        node = lambda n: F.concat(F.lit("N"), n.cast("string")).alias("node")
        own = self.made.withColumn("node", node(F.col("number"))).select(*cols)
        extra = lambda rows, sid, kind, label, n: rows.select(*_KEY, F.lit(sid).alias("statement_id"), F.lit(kind).alias("kind"), F.lit(label).alias("label"), F.lit(None).cast("string").alias("rule_id"), F.lit(2).alias("tier"), F.lit(0).alias("line"), F.lit(1).alias("members"), node(F.lit(n)))
        one = self.made.filter("place = 1")
        return own.unionByName(extra(one, "START", "TERMINAL", "Start", 1)).unionByName(extra(one.filter("caught"), "*", "ERROR", "Any error", 2))

    @cached_property
    def edges(self) -> DataFrame:
        edge = lambda when, source, target, kind, label=None, rule=None: F.when(when, F.struct(source.alias("source"), target.alias("target"), kind.alias("type"), (F.lit("") if label is None else label).alias("label"), (F.lit(None).cast("string") if rule is None else rule).alias("rule_id")))
        error, own, above, scope = F.col("kind") == "ERROR", F.col("number"), F.col("above"), F.col("scope")
        way = F.when(scope.rlike("^(IF|CASE)#"), "BRANCH").when(scope.startswith("EXCEPTION#"), "EXCEPTION").when(scope.startswith("LOOP#"), "LOOP_ENTRY").otherwise("FLOW")
        opens, inner = ~error & F.col("before").isNull(), F.col("parent").isNotNull()
        edges = F.array(
            edge(~error & F.col("before").isNotNull(), F.col("before"), own, F.lit("FLOW")), edge(opens & inner & above.isNotNull(), above, own, way, branch_label(F.col("branch")), F.when(way == "BRANCH", F.col("arm_rule"))),
            edge(~error & F.col("closes") & scope.startswith("LOOP") & above.isNotNull(), own, above, F.lit("LOOP_BACK")), edge(error, F.lit(2), own, F.lit("EXCEPTION"), branch_label(F.col("branch"))), edge(opens & ~inner, F.lit(1), own, F.lit("FLOW")),
        )
        node = lambda n: F.concat(F.lit("N"), F.col(n).cast("string")).alias(n.split(".")[1])
        return self.made.select(*_KEY, F.explode(F.array_compact(edges)).alias("e")).select(*_KEY, node("e.source"), node("e.target"), "e.type", "e.label", "e.rule_id")

    @cached_property
    def report(self) -> DataFrame:
        """Counts need no words, no rules and no edges."""
        marked, head = collapse_runs(_plain(self.code), self.budget), F.col("head") == F.col("statement_id")
        per = marked.groupBy(*_KEY).agg((F.count_if(head) + 1 + F.max((F.col("kind") == "ERROR").cast("int"))).cast("int").alias("nodes"), F.count(F.lit(1)).cast("int").alias("statements"), F.max(~head).alias("collapsed"))
        return per.withColumn("oversize", F.col("nodes") > self.budget)


def flows(code: Code, rules: DataFrame, budget: int = NODE_BUDGET) -> Flows:
    """The process flow of every object. An object over the budget after merging is declared oversize, never cut."""
    return Flows(code, rules, budget)


def flow_text(f: Flows) -> DataFrame:
    """(file_id, object_id, mermaid): one flowchart for each object; nodes in order of line."""
    shape = lambda m: F.element_at(F.create_map(*[F.lit(x) for kv in m.items() for x in kv]), F.col("kind"))
    box = F.concat(F.lit("    "), "node", shape(_OPEN), _text(F.col("label")), shape(_CLOSE))
    lines = f.nodes.select(*_KEY, F.lit(0).alias("rank"), F.substring("node", 2, 9).cast("int").alias("n"), F.lit(0).alias("m"), box.alias("l"))
    named = F.concat_ws(" ", F.when(F.col("label") != "", _text(F.col("label"))), F.when(F.col("rule_id").isNotNull(), F.concat(F.lit("- "), "rule_id")))
    arrow = F.concat(F.lit("    "), "source", F.when(F.col("type").isin("EXCEPTION", "LOOP_BACK"), " -.->").otherwise(" -->"), F.when(named != "", F.concat(F.lit('|"'), named, F.lit('"|'))).otherwise(""), F.lit(" "), "target")
    lines = lines.unionByName(f.edges.select(*_KEY, F.lit(1).alias("rank"), F.substring("source", 2, 9).cast("int").alias("n"), F.substring("target", 2, 9).cast("int").alias("m"), arrow.alias("l")))
    return lines.groupBy(*_KEY).agg(F.concat(F.lit("flowchart TD\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "n", "m", "l"))), lambda x: x["l"]), "\n")).alias("mermaid"))


# -- states ------------------------------------------------------------------------------------------------------------------
def states(code: Code) -> DataFrame:
    """(table_name, name, state): value lists of two or more in a CHECK; a range check is none."""
    listed = sc.columns(code).filter("enum_source = 'check_constraint' AND size(enum_values) >= 2")
    return listed.select("table_name", "name", F.explode("enum_values").alias("state"))


def transitions(code: Code) -> DataFrame:
    """(table_name, name, origin, target, inferred, statement_id): states that an UPDATE writes as a literal. Without such a target there is no transition; an origin is taken from the statement's WHERE or a controlling condition on that very column, else it is open."""
    s = code.rows("statements").filter("type = 'UPDATE'").select("statement_id", *_KEY, "scope_path", "text")
    known = states(code)
    written = sc.column_access(code).filter("mode = 'WRITE'").select("statement_id", "table_name", "name").join(big(known.select("table_name", "name").distinct()), ["table_name", "name"])
    w = written.join(big(s), "statement_id")
    literal = lambda text: F.filter(F.transform(F.regexp_extract_all(text, F.lit(r"(?i)([\w.]+\s*=\s*'[^']*')"), 1), lambda x: F.struct(F.upper(F.regexp_extract(x, r"(\w+)\s*=", 1)).alias("c"), F.regexp_extract(x, "'([^']*)'", 1).alias("v"))), lambda x: F.regexp_replace(x["c"], "^[PVLG]_", "") == F.col("name"))
    w = w.withColumn("to", F.try_element_at(literal(F.regexp_extract("text", r"(?is)\bSET\b(.*?)(?:\bWHERE\b|$)", 1)), F.lit(1))["v"]).withColumn("from", F.try_element_at(literal(F.regexp_extract("text", r"(?is)\bWHERE\b(.*)", 1)), F.lit(1))["v"])
    above = w.select("statement_id", *_KEY, "name", F.explode("scope_path").alias("p")).select("statement_id", *_KEY, "name", F.regexp_extract("p", r"IF#(\d+)", 1).try_cast("int").alias("seq"), F.regexp_extract("p", r"\.(.*)$", 1).alias("arm"))
    guards = above.join(big(code.rows("arms").filter("kind = 'IF' AND condition IS NOT NULL AND NOT upper(condition) RLIKE '\\\\bOR\\\\b'").select(*_KEY, "seq", "arm", "condition")), [*_KEY, "seq", "arm"])
    guards = guards.withColumn("g", F.try_element_at(literal(F.col("condition")), F.lit(1))["v"]).groupBy("statement_id", "name").agg(F.max("g").alias("guard"))
    w = w.filter("to IS NOT NULL").join(big(guards), ["statement_id", "name"], "left").withColumn("from", F.coalesce("from", "guard"))
    w = w.join(big(known.withColumnRenamed("state", "to")), ["table_name", "name", "to"], "left_semi").join(big(known.select("table_name", "name", F.col("state").alias("from"), F.lit(True).alias("real"))), ["table_name", "name", "from"], "left")
    return w.select("table_name", "name", F.when(F.col("real"), F.col("from")).alias("origin"), F.col("to").alias("target"), F.col("real").isNull().alias("inferred"), "statement_id")


def state_text(code: Code) -> DataFrame:
    """(table_name, name, mermaid, unreached): a state diagram for each column of states; `unreached` are states no code moves into."""
    known, moves = states(code), settled(transitions(code))
    word = lambda x: F.regexp_replace(x, r"\W", "_")
    lines = known.select("table_name", "name", F.lit(0).alias("rank"), F.concat(F.lit("    "), word(F.col("state"))).alias("l"))
    arrows = moves.select("table_name", "name", F.lit(1).alias("rank"), F.concat(F.lit("    "), F.coalesce(word(F.col("origin")), F.lit("[*]")), F.lit(" --> "), word(F.col("target")), F.when(F.col("inferred"), " : inferred").otherwise("")).alias("l")).distinct()
    text = lines.unionByName(arrows).groupBy("table_name", "name").agg(F.concat(F.lit("stateDiagram-v2\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "l"))), lambda x: x["l"]), "\n")).alias("mermaid"))
    idle = known.join(big(moves.select("table_name", "name", F.col("target").alias("state"))), ["table_name", "name", "state"], "left_anti").groupBy("table_name", "name").agg(F.array_sort(F.collect_list("state")).alias("unreached"))
    return text.join(big(idle), ["table_name", "name"], "left").withColumn("unreached", F.coalesce("unreached", F.array().cast("array<string>")))


# -- data flow, matrix, quality ------------------------------------------------------------------------------------------------
def dataflow_text(code: Code) -> DataFrame:
    """(rank, line) of the map, which reads in that order: which routine reads or changes which table, and calls."""
    node = lambda x, p: F.concat(F.lit(p), F.regexp_replace(x, r"\W", "_"))
    reads = c.crud(code)
    use = reads.select(F.lit(1).alias("rank"), F.concat(F.lit("    "), node(F.col("object_id"), "O_"), F.lit(' -->|"'), "crud", F.lit('"| '), node(F.col("table_name"), "T_")).alias("l"))
    call = c.calls(code).filter("status = 'resolved'").select(F.lit(2).alias("rank"), F.concat(F.lit("    "), node(F.col("object_id"), "O_"), F.lit(" -.-> "), node(F.col("call_target_object_id"), "O_")).alias("l"))
    who = code.rows("objects").select("object_id").unionByName(reads.select("object_id")).distinct().select(F.lit(0).alias("rank"), F.concat(F.lit("    "), node(F.col("object_id"), "O_"), F.lit('["'), la.object_title(F.col("object_id")), F.lit('"]')).alias("l"))
    what = reads.select("table_name").distinct().select(F.lit(0).alias("rank"), F.concat(F.lit("    "), node(F.col("table_name"), "T_"), F.lit('[("'), la.humanise(F.col("table_name")), F.lit('")]')).alias("l"))
    head = code.facts.sparkSession.createDataFrame([(-1, "flowchart LR")], "rank int, l string")
    return head.unionByName(who).unionByName(what).unionByName(use).unionByName(call).distinct().withColumnRenamed("l", "line")


def write_lines(lines: DataFrame, path: str) -> None:
    """Text files whose names sort as the lines do: by all columns before `line`, then `line`. Ranges of the order are written apart."""
    order = [c for c in lines.columns if c != "line"] + ["line"]
    lines.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order).select("line").write.mode("overwrite").text(path)


def crud_markdown(code: Code) -> DataFrame:
    """(object_id, line): a table row for each object, its tables with their letters."""
    cells = c.crud(code).groupBy("object_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat("table_name", F.lit(": "), "crud"))), ", ").alias("used"))
    return cells.select("object_id", F.concat(F.lit("| "), la.object_title(F.col("object_id")), F.lit(" | "), "used", F.lit(" |")).alias("line"))


def quality(f: Flows) -> DataFrame:
    """One row: share of decisions with a rule's words, share of branches with a rule, leaked and fallback labels, nodes."""
    decision = F.col("kind") == "DECISION"
    n = f.nodes.agg(F.avg(F.when(decision, (F.col("tier") == 1).cast("double"))).alias("decision_label_tier1_pct"), F.count_if(F.col("tier") == 3).alias("fallback_labels"), F.count_if(F.col("label").rlike(la.INTERNAL)).alias("leaked_identifiers"), F.count(F.lit(1)).alias("total_nodes"))
    e = f.edges.agg(F.avg(F.when(F.col("type") == "BRANCH", F.col("rule_id").isNotNull().cast("double"))).alias("branch_traceability_pct"))
    m = f.report.agg(F.max("nodes").alias("max_nodes_any_diagram"))
    return n.join(e).join(m)


def warnings(f: Flows, code: Code) -> DataFrame:
    """(kind, subject, message): figures over the budget, merged detail, states that nothing moves into."""
    over = f.report.filter("oversize").select(F.lit("OVERSIZE").alias("kind"), F.col("object_id").alias("subject"), F.concat(F.col("nodes").cast("string"), F.lit(f" nodes; structure cannot fit in {f.budget}")).alias("message"))
    merged = f.report.filter("collapsed").select(F.lit("DETAIL_COLLAPSED").alias("kind"), F.col("object_id").alias("subject"), F.concat(F.col("statements").cast("string"), F.lit(" statements are shown as "), F.col("nodes").cast("string"), F.lit(" nodes")).alias("message"))
    idle = state_text(code).filter("size(unreached) > 0").select(F.lit("DIAGRAM_NOTE").alias("kind"), F.concat_ws(".", "table_name", "name").alias("subject"), F.concat(F.lit("no code moves into "), F.array_join("unreached", ", ")).alias("message"))
    return over.unionByName(merged).unionByName(idle)


def problems(f: Flows) -> DataFrame:
    """(object_id, problem): what makes a figure unfit; none may be left when figures are written."""
    ends = f.nodes.select(*_KEY, "node")
    blank = f.nodes.filter("trim(label) = ''").select("object_id", F.lit("node without a label").alias("problem"))
    leak = f.nodes.filter(F.col("label").rlike(la.INTERNAL)).select("object_id", F.lit("internal name in a label").alias("problem"))
    loose = f.edges.join(big(ends.withColumnRenamed("node", "target")), [*_KEY, "target"], "left_anti").select("object_id", F.lit("edge without an end").alias("problem"))
    quiet = f.report.filter(f"nodes > {f.budget} AND NOT oversize").select("object_id", F.lit("over the budget, not declared").alias("problem"))
    return blank.unionByName(leak).unionByName(loose).unionByName(quiet)


def write_diagrams(f: Flows, code: Code, root: str) -> None:
    """Tables of figure texts below root; a figure with a problem stops the stage before anything is written."""
    bad = problems(f).limit(5).collect()
    if bad:
        raise ValueError("unfit figures: " + "; ".join(f"{r.object_id}: {r.problem}" for r in bad))
    flow, state = settled(flow_text(f)), settled(state_text(code))
    written = figure_check.faults(flow, _KEY).select("object_id", "fault").unionByName(figure_check.faults(state, ["table_name", "name"]).select(F.concat_ws(".", "table_name", "name").alias("object_id"), "fault"))
    bad = written.limit(5).collect()
    if bad:
        raise ValueError("unfit figures: " + "; ".join(f"{r.object_id}: {r.fault}" for r in bad))
    flow.write.mode("overwrite").json(f"{root}/flows")
    state.write.mode("overwrite").json(f"{root}/states")
    write_lines(dataflow_text(code), f"{root}/system_dataflow")
    write_lines(sc.erd(code), f"{root}/entities")
