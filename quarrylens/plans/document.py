"""The requirements document of a code base: its machine index as tables, and its text as ordered blocks.

A block is a row (chapter, place, text); blocks are ordered by ranges when written, so the document never has to fit one task.
Only contents pages and figures are single texts. Nothing is made up: a value that nobody stated is a visible blank.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import language as la
from . import code as c, diagrams as dg, graph as gr, rules as ru, schema as sc
from .code import Code
from .cut import big, settled

# Blanks for what only a person knows, how loops and objects are named for a reader, severities by weight.
BLANK = "_to be assigned_"
LOOP_WORDS = {"COUNTED_OR_CURSOR_LOOP": "once for each item of a known set", "CONDITION": "while its condition holds", "EXIT": "until a stated condition ends it"}
SHAPE_WORDS = {"BATCH_PROCESSOR": "Batch job that changes records one after another", "SINGLE_RECORD_TRANSACTION": "Single business transaction", "CALCULATION": "Calculation without stored data", "QUERY_ONLY": "Inquiry that changes nothing"}
MODE_WORDS = {"IN": "Supplied by caller", "OUT": "Returned to caller", "IN OUT": "Supplied by caller and returned changed"}
SEVERITIES = ("critical", "high", "medium", "low")
PARTS = ((1, "Front Matter"), (2, "Part I - Business View"), (3, "Part II - Rules and Behaviour"), (4, "Part III - Build Specification"), (5, "Part IV - Assurance"), (6, "Appendices"))
CHAPTERS = (
    (1.1, "Document Control"), (1.2, "Contents"), (1.3, "How to Read This Document"), (2.1, "Executive Summary"), (2.2, "Scope"), (2.3, "Business Glossary"), (2.4, "Program Units"), (3.1, "Business Rules Catalogue"), (3.2, "Entity State Models"),
    (3.3, "Error Handling"), (4.1, "Data Model"), (4.2, "Interface Contracts"), (4.3, "Process Specifications"), (4.4, "Operational Characteristics"), (5.1, "Requirements Traceability Matrix"), (5.2, "Gaps"), (5.3, "Rebuilding This System"), (6.1, "Method"), (6.2, "Reference Scheme"), (6.3, "Standards"),
)


def _words(pairs: dict[str, str], key: Column, other: str) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv]), key), F.lit(other))


def annotations(spark: SparkSession, path: str | None) -> DataFrame:
    """(key, note, owner, priority) of a JSON file {"annotations": {key: {...}}}; a missing or malformed file gives no rows."""
    shape = "annotations map<string, struct<note: string, owner: string, priority: string>>"
    empty = spark.createDataFrame([], "key string, note string, owner string, priority string")
    if not path:
        return empty
    try:
        texts = spark.read.text(path, wholetext=True).collect()
    except Exception as error:  # noqa: BLE001 - only a path that isn't there is forgiven
        if "PATH_NOT_FOUND" in str(error):
            return empty
        raise
    rows = spark.createDataFrame([(r.value,) for r in texts], "t string").select(F.explode(F.from_json("t", shape)["annotations"]).alias("key", "a"))
    return rows.select("key", "a.note", "a.owner", "a.priority")


@dataclass
class Index:
    """The machine index: one table for each kind of record."""

    requirements: DataFrame
    traceability: DataFrame
    glossary: DataFrame
    capabilities: DataFrame
    gaps: DataFrame
    notes: DataFrame


def requirements(rules: DataFrame, notes: DataFrame) -> DataFrame:
    """One record for each rule with the attributes a requirement has; owner and priority come from annotations or stay blank."""
    r = ru.modality(rules) if "modality" not in rules.columns else rules
    text = la.humanise_description(F.col("description"))
    out = r.join(notes.withColumnRenamed("key", "rule_id"), "rule_id", "left")
    return out.select(
        F.col("rule_id").alias("id"), F.col("name").alias("heading"), text.alias("text"), F.col("formal_statement").alias("formal"), "modality", F.col("category").alias("type"), "confidence", "verification_method",
        F.struct("kind", "file_id", "object_id", "statement_id", "line", "condition").alias("source"), F.col("requires_sme_review").alias("needs_review"), F.coalesce("owner", F.lit(BLANK)).alias("owner"), F.coalesce("priority", F.lit(BLANK)).alias("priority"), "note",
    )


def traceability(needs: DataFrame) -> DataFrame:
    """A row for each requirement: where it lives, by line where the source gives one."""
    return needs.select(F.col("id").alias("rule_id"), "source.file_id", "source.object_id", "source.statement_id", "source.line", "verification_method")


def glossary(code: Code) -> DataFrame:
    """(term, kind, technical_name): tables, routines and listed values in words."""
    t = code.rows("tables").select(la.humanise(F.col("table_name")).alias("term"), F.lit("entity").alias("kind"), F.col("table_name").alias("technical_name"))
    o = code.rows("objects").select(la.object_title(F.col("object_id")).alias("term"), F.lit("program unit").alias("kind"), F.col("object_id").alias("technical_name"))
    s = dg.states(code).select(la.humanise(F.col("state")).alias("term"), F.lit("state").alias("kind"), F.concat_ws(".", "table_name", "name", "state").alias("technical_name"))
    return t.unionByName(o).unionByName(s).groupBy("term", "kind").agg(F.array_sort(F.collect_set("technical_name")).alias("technical_names"))


def capabilities(code: Code, rules: DataFrame) -> DataFrame:
    """(object_id, title, shape, transaction, loops, narrative, rules, cyclomatic) of each parsed routine."""
    key = ["file_id", "object_id"]
    tx = c.transactions(code).select(*key, F.when(F.col("commits") == 0, "left to the caller").when(F.col("commit_inside_loop") > 0, "each turn of the loop is made lasting on its own").when(F.col("is_atomic"), "all or nothing").otherwise("in several lasting steps").alias("transaction"), F.transform("hazards", lambda h: h["hazard"]).alias("hazards"))
    loops = c.loops(code).groupBy(*key).agg(F.array_sort(F.collect_set(_words(LOOP_WORDS, F.col("termination_pattern"), "without an end that the source states"))).alias("loops"))
    count = rules.groupBy(*key).agg(F.count(F.lit(1)).alias("rules"))
    rows = c.complexity(code).select(*key, "cyclomatic", "cognitive").join(big(c.shapes(code).select(*key, "shape", "rationale")), key, "left").join(big(tx), key, "left").join(big(loops), key, "left").join(big(count), key, "left")
    empty = F.array().cast("array<string>")
    return rows.select(*key, la.object_title(F.col("object_id")).alias("title"), _words(SHAPE_WORDS, F.col("shape"), "Calculation without stored data").alias("shape"), F.coalesce("transaction", F.lit("left to the caller")).alias("transaction"), F.coalesce("hazards", empty).alias("hazards"), F.coalesce("loops", empty).alias("loops"), F.coalesce("rules", F.lit(0)).alias("rules"), "cyclomatic", "cognitive")


def gaps(code: Code, rules: DataFrame, flows: dg.Flows) -> DataFrame:
    """The open matters of the graph and of the figures, ranked by severity."""
    seen = dg.warnings(flows, code).select(F.lower(F.concat(F.lit("figure_"), "kind")).alias("type"), F.when(F.col("kind") == "OVERSIZE", "medium").otherwise("low").alias("severity"), "subject", F.lit(None).cast("int").alias("line"), "message")
    seen = seen.withColumn("gap_id", F.concat(F.lit("GAP-"), F.upper(F.substring(F.sha2(F.concat_ws("|", "type", "subject"), 256), 1, 10))))
    rank = F.array_position(F.array(*map(F.lit, SEVERITIES)), F.col("severity"))
    return gr.gaps(code, rules).unionByName(seen).withColumn("rank", rank.cast("int"))


def build_index(code: Code, rules: DataFrame, flows: dg.Flows, notes: DataFrame) -> Index:
    needs = settled(requirements(rules, notes))
    return Index(needs, traceability(needs), settled(glossary(code)), settled(capabilities(code, rules)), settled(gaps(code, rules, flows)), notes)


# -- text --------------------------------------------------------------------------------------------------------------------
def _cell(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.coalesce(x.cast("string"), F.lit("-")), r"\s+", " "), r"\|", "\\\\\\\\|")


def _row(*cells: Column) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *map(_cell, cells)), F.lit(" |"))


def _head(*names: str) -> str:
    return f"| {' | '.join(names)} |\n|{'---|' * len(names)}"


def _tick(x: Column) -> Column:
    return F.concat(F.lit("`"), F.coalesce(x.cast("string"), F.lit("-")), F.lit("`"))


def blocks(code: Code, flows: dg.Flows, index: Index, title: str = "System") -> DataFrame:
    """(chapter, place, text) of the whole document; chapters are numbers whose whole part is the part's."""
    spark, col = code.facts.sparkSession, F.col
    fixed: list[tuple[float, str, str]] = [(float(n), "", f"## {name}") for n, name in PARTS] + [(n, "", f"### {name}") for n, name in CHAPTERS]

    def say(chapter: float, *texts: str) -> None:
        fixed.extend((chapter, f"!{k:02d}", t) for k, t in enumerate(texts))

    note = {r.key: r.note for r in index.notes.filter("key IN ('executive_summary', 'scope')").collect()}
    say(0.0, f"# Business Requirements: {title}")
    say(1.1, _head("Attribute", "Value") + f"\n| Owner | {BLANK} |\n| Approver | {BLANK} |\n| Origin of content | derived from source text; no language model generates any of it |")
    say(1.3, "Part I is for sponsors, Part II for analysts, Part III for the build team, Part IV for auditors. Rules are numbered BR-; open matters GAP-. `Needs review` marks what a person has to confirm.")
    say(2.1, note.get("executive_summary") or "_to be supplied_")
    say(2.2, note.get("scope") or "In scope: the program units and tables listed below.", "Out of scope: callers outside the source, statements put together at run time, and the reasons behind thresholds, which source text cannot show.")
    say(2.3, _head("Term", "Kind", "Technical name"))
    say(2.4, _head("Program unit", "What it is", "Rules", "Transaction boundary"))
    say(3.3, _head("Program unit", "Error", "Line"))
    say(5.1, _head("Rule", "Program unit or table", "Line", "Verification"))
    say(5.2, _head("Gap", "Severity", "Type", "Subject", "Message"))
    say(5.3, "Build the data model, then the interfaces, then the processes; verify each rule by the method its row names.")
    say(6.1, "Every statement is read from source and carries its place, so an invented requirement is structurally impossible. The method cannot tell why a rule exists.")
    say(6.2, "BR-nnn: rule. GAP-x: open matter. Nn: node of a figure.")
    say(6.3, "Modality follows the distinction of what cannot be broken (necessary) and what must be done (obligatory).")

    def make(df: DataFrame, chapter: float, place: Column, text: Column) -> DataFrame:
        return df.select(F.lit(chapter).alias("chapter"), place.cast("string").alias("place"), text.alias("text"))

    need = index.requirements
    rule = F.concat_ws(
        "\n", F.concat(F.lit("#### "), "id", F.lit(" "), la.humanise_identifiers(col("heading"))), F.concat(F.lit(""), "text", F.lit(".")), _row(F.lit("Attribute"), F.lit("Value")), F.lit("|---|---|"), _row(F.lit("Formal statement"), _tick(col("formal"))), _row(F.lit("Condition"), _tick(col("source.condition"))),
        _row(F.lit("Type"), F.initcap(F.regexp_replace("type", "_", " "))), _row(F.lit("Modality"), col("modality")), _row(F.lit("Confidence"), F.concat("confidence", F.when(col("needs_review"), " - Needs review").otherwise(""))), _row(F.lit("Verification"), col("verification_method")),
        _row(F.lit("Owner"), col("owner")), _row(F.lit("Priority"), col("priority")), F.when(col("note").isNotNull(), F.concat(F.lit("> "), "note")),
    )
    fence = lambda kind, x: F.concat(F.lit(f"```{kind}\n"), x, F.lit("\n```"))
    cap = index.capabilities
    hazard = F.when(F.size("hazards") > 0, F.concat(F.lit("Transaction behaviour: "), F.array_join(F.transform("hazards", lambda h: F.initcap(F.regexp_replace(h, "_", " "))), ", "), F.lit(".")))
    turns = F.when(F.size("loops") > 0, F.concat(F.lit("Repeats "), F.array_join("loops", "; "), F.lit(".")))
    figure = dg.flow_text(flows)
    pseudo = c.pseudocode(code).select("file_id", "object_id", F.array_join("pseudocode", "\n").alias("code"))
    process = cap.join(big(figure), ["file_id", "object_id"], "left").join(big(pseudo), ["file_id", "object_id"], "left")
    process_text = F.concat_ws("\n", F.concat(F.lit("#### "), "title", F.lit(" - process")), F.concat(F.lit("Transaction boundary: "), "transaction", F.lit(".")), turns, hazard, F.when(col("mermaid").isNotNull(), fence("mermaid", col("mermaid"))), F.when(col("code").isNotNull(), fence("text", col("code"))))
    columns = sc.columns(code).select("table_name", "position", "name", "type", "pyspark_type", "nullable").withColumn("text", _row(la.humanise(col("name")), la.plain_type(col("type")), _tick(col("pyspark_type")), F.when(col("nullable"), "optional").otherwise("required")))
    heads = code.rows("tables").select("table_name", F.lit(0).alias("position"), F.concat(F.lit("#### "), la.humanise(col("table_name")), F.lit("\n"), F.lit(_head("Field", "Meaning", "Rebuild as", "Presence"))).alias("text"))
    model = columns.select("table_name", "position", "text").unionByName(heads)
    params = code.rows("parameters").withColumn("text", _row(la.humanise(col("name")), _words(MODE_WORDS, F.upper("mode"), "Supplied by caller"), la.plain_type(col("type"))))
    faces = params.select("object_id").distinct().select("object_id", F.lit(0).alias("position"), F.concat(F.lit("#### "), la.object_title(col("object_id")), F.lit(" - interface\n"), F.lit(_head("Parameter", "Direction", "Type"))).alias("text"))
    interface = params.select("object_id", "position", "text").unionByName(faces)
    order = lambda *x: F.concat_ws("\u0001", *x)
    pad = lambda x: F.lpad(x.cast("string"), 12, "0")
    parts = [
        make(index.glossary, 2.3, order("term", "kind"), _row(col("term"), col("kind"), _tick(F.array_join("technical_names", ", ")))),
        make(cap, 2.4, order("title", "object_id", "file_id"), _row(col("title"), col("shape"), col("rules"), col("transaction"))),
        make(need, 3.1, F.concat(F.lpad(F.length("id").cast("string"), 3, "0"), "id"), rule),
        make(dg.state_text(code), 3.2, order("table_name", "name"), F.concat(F.lit("#### "), la.humanise(col("table_name")), F.lit(" - "), la.humanise(col("name")), F.lit("\n"), fence("mermaid", col("mermaid")))),
        make(ru.error_catalogue(code), 3.3, order("object_id", pad(col("line"))), _row(la.object_title(col("object_id")), F.array_join(F.transform("handler_for", la.humanise), ", "), col("line"))),
        make(model, 4.1, order("table_name", pad(col("position"))), col("text")),
        make(interface, 4.2, order("object_id", pad(col("position"))), col("text")),
        make(process, 4.3, order("title", "object_id", "file_id"), process_text),
        make(cap, 4.4, order("title", "object_id", "file_id"), F.concat(F.lit("- "), "title", F.lit(": cyclomatic complexity "), col("cyclomatic").cast("string"), F.lit(", cognitive "), col("cognitive").cast("string"))),
        make(index.traceability, 5.1, F.concat(F.lpad(F.length("rule_id").cast("string"), 3, "0"), "rule_id"), _row(col("rule_id"), _tick(col("object_id")), col("line"), col("verification_method"))),
        make(index.gaps, 5.2, order(pad(col("rank")), "gap_id"), _row(col("gap_id"), col("severity"), F.regexp_replace("type", "_", " "), _tick(col("subject")), _tick(col("message")))),
    ]
    listed = [f"{'  ' if n % 1 else ''}- [{name}](#{_anchor(name)})" for n, name in sorted(PARTS + CHAPTERS)]
    say(1.2, "\n".join(listed))
    out = spark.createDataFrame(fixed, "chapter double, place string, text string")
    for p in parts:
        out = out.unionByName(p)
    return out


def _anchor(heading: str) -> str:
    return "".join(ch for ch in heading.lower() if ch.isalnum() or ch in " -_").replace(" ", "-")


def broken_links(document: DataFrame) -> DataFrame:
    """Links of the contents that no heading answers."""
    links = document.filter("chapter = 1.2").select(F.explode(F.regexp_extract_all("text", F.lit(r"\]\(#([\w-]+)\)"), 1)).alias("anchor"))
    heads = document.select(F.explode(F.regexp_extract_all("text", F.lit(r"(?m)^#{2,4} (.+)$"), 1)).alias("h")).select(la.anchor(F.col("h")).alias("anchor"))
    return links.join(heads, "anchor", "left_anti")


def write_document(document: DataFrame, index: Index, root: str) -> None:
    """Text files whose names sort as the document reads, and the index as JSON lines, a folder for each kind of record."""
    ordered = document.repartitionByRange(F.col("chapter"), F.col("place"), F.col("text")).sortWithinPartitions("chapter", "place", "text")
    ordered.select(F.concat("text", F.when(F.col("text").endswith("|"), "").otherwise("\n")).alias("value")).write.mode("overwrite").text(f"{root}/brd")
    for name in ("requirements", "traceability", "glossary", "capabilities", "gaps"):
        getattr(index, name).write.mode("overwrite").option("ignoreNullFields", False).json(f"{root}/brd_index/{name}")


# -- the graph's guide ---------------------------------------------------------------------------------------------------------
def graph_guide(g: gr.Graph) -> DataFrame:
    """Blocks (place, text) of the graph's guide: loading, what it holds, derived views, checks that must be empty, limits."""
    spark = g.nodes.sparkSession
    kinds = g.nodes.groupBy("label").count().select(F.concat(F.lit("2."), "label").alias("place"), F.concat(F.lit("- "), "label", F.lit(": "), F.col("count").cast("string")).alias("text"))
    links = g.edges.groupBy("type").count().select(F.concat(F.lit("3."), "type").alias("place"), F.concat(F.lit("- "), "type", F.lit(": "), F.col("count").cast("string")).alias("text"))
    lost = g.dropped.filter("dropped > 0").select(F.concat(F.lit("6."), "type").alias("place"), F.concat(F.lit("- "), F.col("dropped").cast("string"), F.lit(" relationships "), "type", F.lit(" without both ends were left out")).alias("text"))
    asked = [(f"4.{k:02d}", f"- {i[1]} `{i[5]}`") for k, i in enumerate(gr.INTENTS)]
    fixed = [
        ("1", "# Graph of the code base\nRun the load script; it merges, so a rerun adds nothing. Or import `nodes` and `rels`."), ("2", "## Nodes"), ("3", "## Relationships"), ("4", "## Questions"),
        ("5", "## Views and checks\n- hot columns: more than two dependents\n- rule statements: statements that hold a rule\n- write paths: columns changed through calls\n- no rule without a source, no column without a table, no unenforced rule hidden: each must give no rows"),
        ("6", "## Limits"), *[(f"6.!{k}", f"- {k}: {v}") for k, v in gr.BLIND_SPOTS.items()],
    ]
    return kinds.unionByName(links).unionByName(lost).unionByName(spark.createDataFrame(fixed + asked, "place string, text string"))
