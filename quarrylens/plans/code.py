"""Analyses of a code base as relations over the facts that `sources/plsql.py` reads.

Every analysis joins, groups or windows on the object (or table), never on the whole; one object's facts are bounded by its
source text. Ancestors travel with each statement, so depth, nesting and "inside a loop" need no recursion.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..sources import inventory
from ..sources.plsql import FILES, read_facts
from .cut import big, settled

#: Procedures that are no outside call, limits of the two complexities, the kinds that raise nesting.
BUILTINS = ("RAISE_APPLICATION_ERROR",)
CYCLOMATIC_LIMIT, COGNITIVE_LIMIT = 10, 15
NESTING = ("IF", "LOOP", "CASE", "EXCEPTION_HANDLER")
SCOPES = {"EXCEPTION_HANDLER": "EXCEPTION"}  # how a scope names a kind where it differs
DML = ("INSERT", "UPDATE", "DELETE", "MERGE")
_SLICE = pa.schema([("file_id", pa.string()), ("object_id", pa.string()), ("variable", pa.string()), ("determined_by", pa.list_(pa.int32())), ("depends_on_variables", pa.list_(pa.string()))])


class Code:
    """The facts of a code base, read once; each kind of fact is a DataFrame with its file's id."""

    derives_variables = True  # false where analyses of the logic are not at hand

    def __init__(self, files: DataFrame):
        self.files = files.select("file", "text")
        self.facts = read_facts(self.files).withColumn("file_id", inventory.file_id(F.col("file")))
        self.facts, self._rows = settled(self.facts), {}

    @classmethod
    def of(cls, spark: SparkSession, root: str, exclude: tuple[str, ...] = inventory.EXCLUDED) -> Code:
        return cls(inventory.discover(spark, root, exclude))

    def once(self, name: str, make: Callable[[], DataFrame], write: bool = True) -> DataFrame:
        """A derived table that several analyses use: written at its first use, unless it costs no more than reading it again."""
        if name not in self._rows:
            self._rows[name] = settled(make()) if write else make()
        return self._rows[name]

    def rows(self, name: str) -> DataFrame:
        """One kind of fact: objects, parameters, variables, cursors, statements, arms, issues, tables, columns, constraints, indexes, sequences, views, synonyms, comments."""
        if name in self._rows:
            return self._rows[name]
        out = self.facts.select("file", "file_id", F.explode(name).alias("r")).select("file", "file_id", "r.*")
        if name == "statements":
            # Written flat: every analysis reads some of its columns, out of an array it would read all of them.
            out = settled(out.withColumn("statement_id", statement_id(F.col("seq"))).withColumn("scope", F.coalesce(F.try_element_at("scope_path", F.lit(-1)), F.lit(""))))
        self._rows[name] = out
        return out


def statement_id(seq: Column) -> Column:
    return F.concat("file_id", F.lit("__"), "object_id", F.lit("__STMT_"), F.lpad(seq.cast("string"), 4, "0"))


# -- calls and control flow ------------------------------------------------------------------------------------------------
def calls(code: Code) -> DataFrame:
    return code.once("calls*", lambda: _calls(code))


def _calls(code: Code) -> DataFrame:
    """Each call with what it means: a member of the same package first, then one of the same owner, then any; else unresolved.

    Every way to mean a routine is a key, and a key leads to its least routine: a call has four keys at most and a name that
    many routines share makes no more rows.
    """
    key = lambda kind, *parts: F.concat(F.lit(kind), *[x for p in parts for x in (F.lit("\u0001"), p)])
    objects = code.rows("objects").filter("type IN ('PROCEDURE', 'FUNCTION')").withColumn("last", F.coalesce("member", "name"))
    owner, name, last, qualifier = (F.col(c) for c in ("owner", "name", "last", "qualifier"))
    member = F.array(key("package", owner, name, last), key("any package", name, last))
    routine = F.array(key("owner", owner, last), key("any owner", last))
    ways = objects.select(F.col("object_id").alias("target_id"), F.explode(F.when(F.col("member").isNotNull(), member).otherwise(routine)).alias("key"))
    ways = ways.filter("key IS NOT NULL").groupBy("key").agg(F.min("target_id").alias("target_id"))
    caller = code.rows("objects").select("file_id", "object_id", "owner", "name")
    made = code.rows("statements").filter("type = 'CALL'").drop("name").join(big(caller), ["file_id", "object_id"])
    made = made.withColumn("parts", F.split("call_target", r"\.")).withColumn("last", F.element_at("parts", -1)).withColumn("qualifier", F.when(F.size("parts") > 1, F.element_at("parts", -2)))
    ranked = lambda *each: F.array(*[F.struct(F.lit(rank).alias("rank"), k.alias("key")) for rank, k in each])
    plain = ranked((1, key("package", owner, name, last)), (2, key("owner", owner, last)), (3, key("any owner", last)))
    within = ranked((2, key("package", owner, qualifier, last)), (2, F.when(qualifier == owner, key("owner", owner, last))), (3, key("any package", qualifier, last)), (3, key("owner", qualifier, last)))
    asked = made.select("statement_id", "file_id", "object_id", "line", "call_target", F.explode_outer(F.when(qualifier.isNull(), plain).otherwise(within)).alias("way")).select("*", "way.rank", "way.key")
    found = asked.filter("key IS NOT NULL OR rank IS NULL OR rank = 3").join(big(ways), "key", "left")
    best = found.groupBy("statement_id", "file_id", "object_id", "line", "call_target").agg(F.min(F.when(F.col("target_id").isNotNull(), F.struct("rank", "target_id"))).alias("best"))
    status = F.when(F.col("best").isNotNull(), "resolved").when(F.col("call_target").isin(*BUILTINS), "builtin").otherwise("unresolved_reference")
    return best.select("statement_id", "file_id", "object_id", "line", "call_target", F.col("best.target_id").alias("call_target_object_id"), status.alias("status"))


def control_flow(code: Code) -> DataFrame:
    return code.once("control_flow*", lambda: _control_flow(code), write=False)


def entry_label(scope: Column) -> Column:
    """What the way into a scope is called; a plain block has no condition."""
    arm = F.regexp_extract(scope, r"\.([A-Z]+)", 1)
    return (
        F.when(arm == "THEN", "true").when(arm == "ELSIF", "elsif").when(arm == "ELSE", "false").when(scope.startswith("LOOP"), "loop body").when(scope.startswith("EXCEPTION"), F.concat(F.lit("WHEN("), F.regexp_extract(scope, r"\.(.*)", 1), F.lit(")")))
        .when(arm == "WHEN", F.concat(F.lit("WHEN("), F.regexp_extract(scope, r"WHEN(\d+)", 1), F.lit(")"))).otherwise("block")
    )


def handler_label(names: Column) -> Column:
    return F.concat(F.lit("WHEN("), F.array_join(names, " OR "), F.lit(")"))


def _control_flow(code: Code) -> DataFrame:
    """Edges (file_id, object_id, source, target, type, branch); `*` as a source stands for the whole block of a handler.

    A statement's row names the sibling after it and tells whether it opens its scope, so each row gives its own edges.
    """
    s = code.rows("statements")
    handler, at = F.col("type") == "EXCEPTION_HANDLER", statement_id
    edge = lambda when, source, target, kind, branch=None: F.when(when, F.struct(source.alias("source"), target.alias("target"), F.lit(kind).alias("type"), (F.lit(None).cast("string") if branch is None else branch).alias("branch")))
    own, above = F.col("statement_id"), at(F.col("parent"))
    edges = F.array(
        edge(F.col("next").isNotNull(), own, at(F.col("next")), "SEQUENCE"), edge(F.col("opens") & F.col("parent").isNotNull(), above, own, "BRANCH_ENTRY", entry_label(F.col("scope"))),
        edge(F.col("next").isNull() & ~handler & F.col("scope").startswith("LOOP"), own, above, "LOOP_BACK_EDGE"), edge(handler, F.lit("*"), own, "EXCEPTION_EDGE", handler_label(F.col("handler_for"))),
    )
    return s.select("file_id", "object_id", F.explode(F.array_compact(edges)).alias("e")).select("file_id", "object_id", "e.*")


# -- metrics ---------------------------------------------------------------------------------------------------------------
def _nesting(code: Code) -> DataFrame:
    """Each statement with how many of its ancestors raise nesting. The ways to a statement name its ancestors' kinds, so nothing is joined."""
    kinds = F.transform("scope_path", lambda x: F.substring_index(x, "#", 1))
    raising = F.size(F.filter(kinds, lambda x: x.isin(*[SCOPES.get(k, k) for k in NESTING]))).cast("long")
    has = lambda kind: F.array_contains(kinds, SCOPES.get(kind, kind))
    return code.rows("statements").withColumns({"nesting": raising, "in_loop": has("LOOP"), "in_handler": has("EXCEPTION_HANDLER")})


def complexity(code: Code) -> DataFrame:
    """Cyclomatic (decisions + 1) and cognitive complexity of each object with their parts; a plain block raises neither."""
    keys = ["file_id", "object_id"]
    s = _nesting(code)
    structural = F.col("type").isin(*NESTING)
    loop_logic = F.when(F.col("type").isin("LOOP", "EXIT", "CONTINUE"), F.col("logical")).otherwise(0)
    loop_runs = F.when(F.col("type").isin("LOOP", "EXIT", "CONTINUE"), F.col("sequences")).otherwise(0)
    per = s.groupBy(*keys).agg(
        F.count_if(F.col("type") == "IF").alias("n_if"), F.count_if(F.col("type") == "LOOP").alias("n_loop"), F.count_if(F.col("type") == "EXCEPTION_HANDLER").alias("n_handler"), F.sum(loop_logic).alias("s_logical"),
        F.sum(loop_runs).alias("s_sequences"), F.count_if(structural).alias("structural"), F.sum(F.when(structural, F.col("nesting")).otherwise(0)).alias("nesting"), F.count(F.lit(1)).alias("n_statements"),
    )
    of_if = F.col("kind") == "IF"
    arms = code.rows("arms").groupBy(*keys).agg(
        F.count_if(of_if & F.col("arm").startswith("ELSIF")).alias("n_elsif"), F.count_if(F.col("arm").startswith("WHEN")).alias("n_case_when"),
        F.count_if(of_if & ((F.col("arm") == "ELSE") | F.col("arm").startswith("ELSIF"))).alias("hybrid_else_elsif"), F.sum("logical").alias("a_logical"), F.sum("sequences").alias("a_sequences"),
        F.count_if((F.col("kind") == "CASE_EXPRESSION") & (F.col("ordinal") == 1)).alias("case_expressions"),  # statements that have some
    )
    both = code.rows("objects").filter("parse_status = 'parsed'").select(*keys).join(big(per), keys, "left").join(big(arms), keys, "left").fillna(0)
    both = both.withColumn("n_logical", F.col("s_logical") + F.col("a_logical")).withColumn("logical_sequences", F.col("s_sequences") + F.col("a_sequences"))
    both = both.withColumn("cyclomatic", 1 + F.col("n_if") + F.col("n_elsif") + F.col("n_case_when") + F.col("n_loop") + F.col("n_handler") + F.col("n_logical"))
    both = both.withColumn("structural", F.col("structural") + F.col("case_expressions")).withColumn("cognitive", F.col("structural") + F.col("nesting") + F.col("hybrid_else_elsif") + F.col("logical_sequences"))
    out = [*keys, "n_statements", "n_if", "n_elsif", "n_case_when", "n_loop", "n_handler", "n_logical", "cyclomatic", "structural", "nesting", "hybrid_else_elsif", "logical_sequences", "cognitive"]
    return both.select(*out, (F.col("cyclomatic") > CYCLOMATIC_LIMIT).alias("exceeds_cyclomatic"), (F.col("cognitive") > COGNITIVE_LIMIT).alias("exceeds_cognitive"))


def crud(code: Code) -> DataFrame:
    """(object, table) with the subset of C, R, U, D that the object does; cursors read too."""
    used = code.rows("statements").select("file_id", "object_id", F.explode("access").alias("a")).select("file_id", "object_id", F.upper("a.table_name").alias("table_name"), F.col("a.crud").alias("c"))
    opened = code.rows("cursors").select("file_id", "object_id", F.explode(F.transform("tables", F.upper)).alias("table_name"), F.lit("R").alias("c"))
    letters = [F.when(F.max(F.col("c") == x), x).otherwise("") for x in "CRUD"]
    return used.unionByName(opened).groupBy("file_id", "object_id", "table_name").agg(F.concat(*letters).alias("crud"))


def transactions(code: Code) -> DataFrame:
    """Commits, rollbacks, savepoints, segments, atomicity and hazards of each object."""
    s = _nesting(code)
    is_commit = F.col("type") == "COMMIT"
    per = s.groupBy("file_id", "object_id").agg(
        F.count_if(is_commit).cast("int").alias("commits"), F.count_if(F.col("type") == "ROLLBACK").cast("int").alias("rollbacks"), F.count_if(F.col("type") == "SAVEPOINT").cast("int").alias("savepoints"),
        F.count_if(is_commit & F.col("in_loop")).cast("int").alias("commit_inside_loop"), F.count_if((F.col("type") == "ROLLBACK") & F.col("in_handler")).cast("int").alias("rollback_in_exception_handler"),
        F.max(F.when(F.col("type").isin(*DML), F.col("seq"))).alias("last_dml"), F.max(F.when(is_commit & ~F.col("in_handler"), F.col("seq"))).alias("last_commit"),
    )
    hazards = F.filter(
        F.array(
            F.when(F.col("commit_inside_loop") > 0, F.struct(F.lit("COMMIT_INSIDE_LOOP").alias("hazard"), F.lit("high").alias("severity"), F.lit("ORA-01555: the open cursor may lose its undo; work done before a failure stays").alias("explanation"))),
            F.when(F.col("savepoints") > 0, F.struct(F.lit("SAVEPOINT_PARTIAL_ROLLBACK").alias("hazard"), F.lit("high").alias("severity"), F.lit("partial undo has no counterpart in a set-based job").alias("explanation"))),
            F.when(F.col("commits") + F.col("rollbacks") == 0, F.struct(F.lit("NO_TRANSACTION_CONTROL").alias("hazard"), F.lit("info").alias("severity"), F.lit("the caller owns the boundary").alias("explanation"))),
        ),
        lambda x: x.isNotNull(),
    )
    open_end = F.col("last_dml").isNotNull() & (F.col("last_dml") > F.coalesce("last_commit", F.lit(0)))
    return per.select("file_id", "object_id", "commits", "rollbacks", "savepoints", "commit_inside_loop", "rollback_in_exception_handler", ((F.col("commits") <= 1) & (F.col("commit_inside_loop") == 0)).alias("is_atomic"), ((F.col("commits") == 0) | open_end).alias("open_segment"), hazards.alias("hazards"))


def transaction_segments(code: Code) -> DataFrame:
    """The runs of statements between commits outside handlers; the last one without a commit is left to the caller."""
    s = _nesting(code).filter("NOT in_handler AND type <> 'EXCEPTION_HANDLER'")
    order = Window.partitionBy("file_id", "object_id").orderBy("seq")
    before = F.sum((F.col("type") == "COMMIT").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    cut = s.withColumn("segment", F.coalesce(before, F.lit(0)).cast("int"))
    out = cut.groupBy("file_id", "object_id", "segment").agg(F.min("line").alias("first_line"), F.max("end_line").alias("last_line"), F.count_if(F.col("type").isin(*DML)).alias("dml"), F.max(F.col("type") == "COMMIT").alias("committed"))
    return out.withColumn("note", F.when(~F.col("committed"), "no COMMIT: left to the caller"))


def shapes(code: Code) -> DataFrame:
    """What an object is: a batch, one transaction, a calculation or a query; with whether it writes inside a loop."""
    s = _nesting(code)
    dml = F.col("type").isin(*DML)
    per = s.groupBy("file_id", "object_id").agg(F.max(dml).alias("writes"), F.max(dml & F.col("in_loop")).alias("dml_inside_loop"), F.max(F.size("access") > 0).alias("touches"))
    shape = F.when(F.col("dml_inside_loop"), "BATCH_PROCESSOR").when(F.col("writes"), "SINGLE_RECORD_TRANSACTION").when(F.col("touches"), "QUERY_ONLY").otherwise("CALCULATION")
    why = F.when(F.col("dml_inside_loop"), "writes inside a loop").when(F.col("writes"), "writes outside loops").when(F.col("touches"), "reads tables only").otherwise("touches no table")
    return per.select("file_id", "object_id", shape.alias("shape"), "dml_inside_loop", why.alias("rationale"))


def loops(code: Code) -> DataFrame:
    """Each loop with how it ends; one without an exit warns."""
    s = code.rows("statements")
    leave = s.filter("type IN ('EXIT', 'RETURN', 'RAISE', 'GOTO')").select("file_id", "object_id", F.explode("ancestors").alias("seq")).distinct().withColumn("leaves", F.lit(True))
    kind = F.when(F.upper("text").startswith("FOR"), "COUNTED_OR_CURSOR_LOOP").when(F.upper("text").startswith("WHILE"), "CONDITION").when(F.col("leaves"), "EXIT")
    return s.filter("type = 'LOOP'").join(big(leave), ["file_id", "object_id", "seq"], "left").select("statement_id", "file_id", "object_id", "line", kind.alias("termination_pattern"), kind.isNull().alias("warns"))


def no_internal_callers(code: Code) -> DataFrame:
    """Routines that nothing in the code base calls: information, not a finding."""
    called = calls(code).select(F.col("call_target_object_id").alias("object_id")).filter("object_id IS NOT NULL")
    return code.rows("objects").filter("type IN ('PROCEDURE', 'FUNCTION')").select("file_id", "object_id").join(big(called), "object_id", "left_anti")


def slices(code: Code) -> DataFrame:
    return code.once("slices*", lambda: _slices(code))


def _slices(code: Code) -> DataFrame:
    """Backward slice of every assigned variable: statements that determine it, with the controlling ones, and variables it depends on.

    An object's statements lie in one file, so each file's row is worked on where it is, without a shuffle.
    """
    part = lambda name, *fields: F.transform(name, lambda r: F.struct(*[r[f].alias(f) for f in fields])).alias(name)
    facts = code.facts.select("file_id", part("statements", "object_id", "seq", "ancestors", "targets", "sources", "type"), part("variables", "object_id", "name"), part("parameters", "object_id", "name"))

    def close(rows: dict[int, dict], names: set[str]) -> Iterator[tuple]:
        makers: dict[str, list[int]] = {}
        for seq, r in rows.items():
            for t in r["targets"] or ():
                makers.setdefault(t, []).append(seq)
        for variable in makers:
            todo, seen, depends = [variable], set(), {variable}
            while todo:
                for seq in makers.get(todo.pop(), ()):
                    for k in (seq, *(rows[seq]["ancestors"] or ())):
                        if k in seen or rows[k]["type"] == "BLOCK":
                            continue
                        seen.add(k)
                        fresh = [x for x in rows[k]["sources"] or () if x not in depends and (x in names or x in makers or x.split(".")[0] in makers)]
                        depends.update(fresh)
                        todo += [y for x in fresh for y in {x, x.split(".")[0]}]
            yield variable, sorted(seen), sorted(depends - {variable})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (batch.slice(lo, FILES) for batch in batches for lo in range(0, batch.num_rows, FILES)):
            out = []
            for file in part.to_pylist():
                objects, known = {}, {}
                for r in file["statements"] or ():
                    objects.setdefault(r["object_id"], {})[r["seq"]] = r
                for r in (file["variables"] or []) + (file["parameters"] or []):
                    known.setdefault(r["object_id"], set()).add(r["name"])
                out += [(file["file_id"], object_id, *found) for object_id, rows in objects.items() for found in close(rows, known.get(object_id, set()))]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(_SLICE.types)], schema=_SLICE)

    return facts.mapInArrow(run, "file_id string, object_id string, variable string, determined_by array<int>, depends_on_variables array<string>")


def pseudocode(code: Code) -> DataFrame:
    """The lines of each object in order, indented by depth; branch heads kept, handlers under a heading of their own."""
    s = _nesting(code)
    key, pad = ["file_id", "object_id"], lambda d: F.repeat(F.lit("  "), d)
    flat = F.regexp_replace("text", r"\s+", " ")
    in_handler = F.col("in_handler") | (F.col("type") == "EXCEPTION_HANDLER")
    head = F.when(F.col("type") == "IF", F.concat(F.lit("IF "), F.regexp_replace("condition", r"\s+", " "), F.lit(" THEN"))).when(F.col("type") == "EXCEPTION_HANDLER", F.concat(F.lit("WHEN "), F.array_join("handler_for", " OR "))).otherwise(flat)
    own = s.select(*key, in_handler.alias("late"), F.col("line").alias("at"), F.lit(0).alias("rank"), F.col("seq").alias("tie"), F.concat(pad(F.col("depth")), head).alias("code"))
    heads = s.filter("type = 'IF'").select(*key, "seq", "depth", in_handler.alias("late"))
    arms = code.rows("arms").filter("kind = 'IF' AND arm <> 'THEN'").join(big(heads), [*key, "seq"])
    other = arms.select(*key, "late", F.col("line").alias("at"), F.lit(0).alias("rank"), F.col("seq").alias("tie"), F.concat(pad(F.col("depth")), F.when(F.col("arm") == "ELSE", "ELSE").otherwise(F.concat(F.lit("ELSIF "), F.regexp_replace("condition", r"\s+", " "), F.lit(" THEN")))).alias("code"))
    ends = s.filter("type IN ('IF', 'LOOP', 'CASE', 'BLOCK')").select(*key, in_handler.alias("late"), F.col("end_line").alias("at"), F.lit(1).alias("rank"), (-F.col("seq")).alias("tie"), F.concat(pad(F.col("depth")), F.lit("END"), F.when(F.col("type") == "BLOCK", "").otherwise(F.concat(F.lit(" "), "type"))).alias("code"))
    rule = s.filter("type = 'EXCEPTION_HANDLER'").select(*key).distinct().select(*key, F.lit(True).alias("late"), F.lit(0).alias("at"), F.lit(0).alias("rank"), F.lit(0).alias("tie"), F.lit("EXCEPTION HANDLING:").alias("code"))
    lines = own.unionByName(other).unionByName(ends).unionByName(rule)
    return lines.groupBy(*key).agg(F.transform(F.sort_array(F.collect_list(F.struct("late", "at", "rank", "tie", "code"))), lambda x: x["code"]).alias("pseudocode"))


def narrative(code: Code) -> DataFrame:
    """One sentence on each object: shape, both complexities, and the exceptions it handles, each once."""
    caught = code.rows("statements").filter("type = 'EXCEPTION_HANDLER'").select("file_id", "object_id", F.explode("handler_for").alias("h")).groupBy("file_id", "object_id").agg(F.array_join(F.sort_array(F.collect_set("h")), ", ").alias("handled"))
    rows = complexity(code).join(big(shapes(code)), ["file_id", "object_id"]).join(big(caught), ["file_id", "object_id"], "left")
    text = F.concat(F.col("object_id"), F.lit(" is a "), "shape", F.lit(" of "), F.col("n_statements").cast("string"), F.lit(" statements (cyclomatic "), F.col("cyclomatic").cast("string"), F.lit(", cognitive "), F.col("cognitive").cast("string"), F.lit(")"), F.coalesce(F.concat(F.lit(", including handlers of "), "handled"), F.lit("")), F.lit("."))
    return rows.select("file_id", "object_id", text.alias("narrative"))
