"""Stages that work from the runs of earlier stages, not from the source.

Each stage writes its tables as a run (`sources/runs`); a later stage is put together from the latest runs it finds. The parser's run is required
everywhere; any other may be absent, unreadable or older, and then what rests on it is left out and the run is named. A run is a `Code`
whose facts and shared analyses are read from the artefacts, so the same analyses serve both ways.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources import inventory as inv, runs
from . import code as c, diagrams as dg, document as do, graph as gr, rules as ru, schema as sc
from .code import Code

#: The stages in order; all but the parser may be absent from a graph.
STAGES = ("inventory", "parser", "data", "logic", "rules", "diagrams", "document")
#: Which run holds a kind of fact or a shared analysis.
FACTS = {"parser": ("objects", "parameters", "variables", "cursors", "statements", "arms", "issues"), "data": ("tables", "columns", "constraints", "indexes", "sequences", "views", "synonyms", "comments")}
SHARED: dict[str, dict[str, Callable[[Code], DataFrame]]] = {
    "parser": {"calls*": c.calls, "control_flow*": c.control_flow, "nesting*": c._nesting},
    "data": {"columns*": sc.columns},
    "logic": {"slices*": c.slices, "column_access*": sc.column_access},
    "rules": {"mined*": ru.mined},
}


def _table(name: str) -> str:
    return f"shared_{name.rstrip('*')}" if name.endswith("*") else f"fact_{name}"


class Artefacts(Code):
    """The latest runs below root, as a code base. `absent` names the stages without a readable run, `versions` those there are."""

    def __init__(self, spark: SparkSession, root: str, leave_out: tuple[str, ...] = ()):
        self.spark, self.root, self._rows, self.versions = spark, root, {}, {}
        for stage in STAGES:
            if stage in leave_out:
                continue
            try:
                self.versions[stage] = runs.latest(spark, root, stage)["run_version"]
            except (FileNotFoundError, KeyError, ValueError, TypeError, PySparkException):
                continue
        self.absent = [s for s in STAGES if s not in self.versions]
        if "parser" in self.absent:
            raise FileNotFoundError(f"no finished run of parser below {root}")
        self.facts = self._of("inventory", "files", lambda: spark.createDataFrame([], "file_id string, file string")).select("file_id", "file")
        self.derives_variables = "logic" in self.versions
        self._none = None

    def _of(self, stage: str, table: str, none: Callable[[], DataFrame]) -> DataFrame:
        """A table of a stage's run; without one, the empty table of the same columns."""
        if stage in self.versions:
            try:
                return runs.load_run(self.spark, self.root, stage, table, self.versions[stage])
            except (KeyError, ValueError, TypeError, PySparkException):  # a run that holds no such table
                if stage == "parser":
                    raise
        return none().limit(0)

    @property
    def none(self) -> Code:
        """A code base without files, for the columns of what is absent."""
        if self._none is None:
            self._none = Code(self.spark.createDataFrame([], "file string, text string"))
        return self._none

    def rows(self, name: str) -> DataFrame:
        if name not in self._rows:
            stage = next(s for s, kinds in FACTS.items() if name in kinds)
            self._rows[name] = self._of(stage, _table(name), lambda: self.none.rows(name))
        return self._rows[name]

    def once(self, name: str, make: Callable[[], DataFrame], write: bool = True) -> DataFrame:
        stage = next((s for s, kinds in SHARED.items() if name in kinds), None)
        if stage is None or (stage == "rules" and "rules" not in self.versions):
            return super().once(name, make, write)
        if name not in self._rows:
            self._rows[name] = self._of(stage, _table(name), lambda: SHARED[stage][name](self.none))
        return self._rows[name]


def _facts(code: Code, stage: str) -> dict[str, DataFrame]:
    return {_table(k): code.rows(k) for k in FACTS.get(stage, ())} | {_table(k): f(code) for k, f in SHARED.get(stage, {}).items()}


def tables_of(code: Code, stage: str) -> dict[str, DataFrame]:
    """What a stage writes, from a source tree or from the runs before it."""
    if stage == "parser":
        return _facts(code, stage) | {"objects": code.rows("objects"), "statements": code.rows("statements"), "issues": code.rows("issues"), "flow": c.control_flow(code), "calls": c.calls(code)}
    if stage == "data":
        return _facts(code, stage) | {"tables": code.rows("tables"), "columns": sc.columns(code), "constraints": sc.constraints(code), "relationships": sc.inferred_relationships(code), "catalogue": sc.column_catalogue(code), "candidates": sc.rule_candidates(code)}
    if stage == "logic":
        return _facts(code, stage) | {"complexity": c.complexity(code), "transactions": c.transactions(code), "shapes": c.shapes(code), "slices": c.slices(code), "pseudocode": c.pseudocode(code), "narrative": c.narrative(code), "crud": c.crud(code)}
    if stage == "rules":
        rules = ru.rules(code)
        return _facts(code, stage) | {"rules": ru.modality(rules), "rule_sets": ru.rule_sets(rules), "error_catalogue": ru.error_catalogue(code, rules)}
    raise ValueError(f"no tables of {stage}")


def inventory_tables(files: DataFrame) -> dict[str, DataFrame]:
    rows = inv.route_ddl(inv.inventory(files))
    return {"files": rows, "summary": inv.summary(rows), "features": inv.feature_counts(rows), "high_complexity": inv.high_complexity(rows)}


def diagram_tables(code: Code, flows: dg.Flows) -> dict[str, DataFrame]:
    return {"flow_nodes": flows.nodes, "flow_edges": flows.edges, "states": dg.states(code), "transitions": dg.transitions(code)}


def document_tables(index: do.Index) -> dict[str, DataFrame]:
    notes = index.requirements.select(F.col("id").alias("rule_id"), "modality", F.col("formal").alias("formal_statement"), "verification_method")
    return {"requirements": index.requirements, "traceability": index.traceability, "glossary": index.glossary, "capabilities": index.capabilities, "gaps": index.gaps, "rule_notes": notes}


_RULES = "rule_id string, kind string, name string, line int, confidence string, requires_sme_review boolean, is_enforced boolean, statement_id string, file_id string, object_id string, subject string, raw_key string"


def parts(runs_: Artefacts) -> gr.Parts:
    """What a graph takes from the runs: no complexities without logic, no rules without rules, no gaps and no modality without the document, no moves between states without the figures."""
    empty = runs_.spark.createDataFrame
    rules = runs_._of("rules", "rules", lambda: empty([], _RULES))
    notes = runs_._of("document", "rule_notes", lambda: empty([], "rule_id string, modality string, formal_statement string, verification_method string"))
    rules = rules.drop("modality", "formal_statement", "verification_method").join(notes, "rule_id", "left")
    gaps = runs_._of("document", "gaps", lambda: empty([], "type string, severity string, subject string, line int, message string, gap_id string"))
    complexity = runs_._of("logic", "complexity", lambda: empty([], "file_id string, object_id string, cyclomatic int")).select("file_id", "object_id", "cyclomatic")
    moves = runs_._of("diagrams", "transitions", lambda: empty([], "table_name string, name string, origin string, target string, inferred boolean, statement_id string"))
    return gr.Parts(runs_.facts, rules, gaps, complexity, moves)


def graph_from_runs(runs_: Artefacts) -> gr.Graph:
    return gr.build(runs_, parts(runs_))


def rules_of(runs_: Artefacts) -> DataFrame:
    """The rules' run; without one, rules mined from the parser's and the data model's. Without logic none derives a variable."""
    return runs_._of("rules", "rules", lambda: runs_.none) if "rules" in runs_.versions else ru.modality(ru.rules(runs_))


def write_source_runs(spark: SparkSession, source: str, out: str, stages: tuple[str, ...] = STAGES, notes: str | None = None) -> dict[str, str]:
    """All stages over a source tree, each written and the later ones made from the runs before them; the versions."""
    versions, written = {}, lambda stage, tables: versions.setdefault(stage, runs.write_run(spark, out, stage, tables))
    if "inventory" in stages:
        written("inventory", inventory_tables(inv.discover(spark, source)))
    code = Code.of(spark, source)
    for stage in ("parser", "data", "logic"):
        if stage in stages:
            written(stage, tables_of(code, stage))
    if "rules" in stages:
        written("rules", tables_of(Artefacts(spark, out, leave_out=("rules", *[s for s in STAGES[3:] if s not in stages])), "rules"))
    if {"diagrams", "document"} & set(stages):
        at = Artefacts(spark, out)
        rules = rules_of(at)
        flows = dg.flows(at, rules)
        if "diagrams" in stages:
            written("diagrams", diagram_tables(at, flows))
        if "document" in stages:
            written("document", document_tables(do.build_index(at, rules, flows, do.annotations(spark, notes))))
    return versions
