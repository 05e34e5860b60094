"""Facts of procedural source files: objects, parameters, variables, cursors, statements and branches.

A file is one row and is read once, in Arrow batches, without looking at other files; what spans files (calls, types) is
joined afterwards in `plans/code.py`. A routine that cannot be read gives an issue, never an error of the task.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from .ddl import DDL_FIELDS, read_ddl
from .lexer import Token, closing, dotted, find_top, identifiers, logic, slice_of, split_top, tokens_of

_ARRAYS = {
    "objects": "object_id: string, type: string, owner: string, name: string, member: string, line: int, end_line: int, parse_status: string, return_type: string, on_table: string",
    "parameters": "object_id: string, position: int, name: string, mode: string, type: string, default: string",
    "variables": "object_id: string, name: string, kind: string, type: string, line: int",
    "cursors": "object_id: string, name: string, tables: array<string>, predicate: string, line: int",
    "statements": "object_id: string, seq: int, parent: int, ancestors: array<int>, scope_path: array<string>, depth: int, type: string, line: int, end_line: int, text: string, condition: string, logical: int, sequences: int, "
    "access: array<struct<table_name: string, crud: string>>, writes: array<string>, reads: array<string>, predicate_reads: array<string>, targets: array<string>, sources: array<string>, "
    "call_target: string, handler_for: array<string>, name: string, requires_manual_review: boolean, next: int, opens: boolean, arm_line: int",
    "arms": "object_id: string, seq: int, kind: string, arm: string, ordinal: int, condition: string, result: string, line: int, logical: int, sequences: int, of: string, refuses: boolean",
    "issues": "type: string, object_id: string, line: int, message: string",
} | DDL_FIELDS
FACTS_SCHEMA = "file string, " + ", ".join(f"{name} array<struct<{fields}>>" for name, fields in _ARRAYS.items())
_NONE: list = []  # of a row that has none; never changed
FILES = 256  # whose facts are held as Python objects at once
_PREFIX = {"PROCEDURE": "PROC", "FUNCTION": "FUNC", "PACKAGE": "PKGS", "PACKAGE BODY": "PKGB", "TRIGGER": "TRG"}
_STOPS = frozenset(("END", "ELSE", "ELSIF", "EXCEPTION", "WHEN"))
_NESTS = {"IF", "LOOP", "CASE", "EXCEPTION_HANDLER"}
_LEAVES = {
    "INSERT": "INSERT", "UPDATE": "UPDATE", "DELETE": "DELETE", "MERGE": "MERGE", "COMMIT": "COMMIT", "ROLLBACK": "ROLLBACK", "SAVEPOINT": "SAVEPOINT", "RAISE": "RAISE", "RETURN": "RETURN", "EXIT": "EXIT",
    "CONTINUE": "CONTINUE", "NULL": "NULL", "OPEN": "OPEN_CURSOR", "FETCH": "FETCH", "CLOSE": "CLOSE_CURSOR", "EXECUTE": "DYNAMIC_SQL", "GOTO": "GOTO", "FORALL": "FORALL", "PIPE": "PIPE_ROW", "SELECT": "SELECT_INTO", "WITH": "SELECT_INTO",
}
_TABLE_WORDS = {"FROM", "JOIN", "INTO", "UPDATE", "USING"}


class Unreadable(ValueError):
    def __init__(self, line: int, message: str):
        super().__init__(message)
        self.line = line


def tables_in(run: list[Token], skip_into: bool = False) -> list[str]:
    """Tables named after FROM, JOIN, USING, UPDATE or INTO, and after a comma of a FROM list; lower case, without owner or link."""
    out = []
    for k, t in enumerate(run):
        if t.text not in _TABLE_WORDS or t.kind != "word" or (t.text == "INTO" and skip_into) or (t.text == "USING" and run[0].text != "MERGE") or (t.text == "UPDATE" and k and run[k - 1].text == "FOR"):
            continue
        if t.text == "FROM" and k > 1 and run[k - 2].text == "(" and run[k - 1].text in ("YEAR", "MONTH", "DAY", "HOUR", "MINUTE", "SECOND"):
            continue
        at = k + 1
        while at < len(run) and run[at].kind == "word":
            parts, at = dotted(run, at)
            if at < len(run) and run[at].text == "(" and t.text in ("FROM", "JOIN"):
                break
            if parts[-1].lower() not in out:
                out.append(parts[-1].lower())
            if at < len(run) and run[at].kind == "word" and run[at].text not in ("WHERE", "JOIN", "LEFT", "RIGHT", "INNER", "FULL", "CROSS", "ON", "SET", "GROUP", "ORDER", "FOR", "CONNECT", "START", "HAVING", "UNION", "MINUS", "INTERSECT", "VALUES", "SELECT", "USING", "WHEN", "PARTITION"):
                at += 1
            if t.text != "FROM" or at >= len(run) or run[at].text != ",":
                break
            at += 1
    return out


def _fields(run: list[Token], variables: set[str]) -> list[str]:
    """Columns read: identifiers that are no variables, without their qualifier."""
    return _fields_of(identifiers(run), variables)


def _fields_of(names: list[str], variables: set[str]) -> list[str]:
    return list(dict.fromkeys(n.rpartition(".")[2].lower() for n in names if n not in variables and n.partition(".")[0] not in variables))


def _dml(kind: str, run: list[Token], variables: set[str]) -> dict:
    where = find_top(run, "WHERE")
    predicate = run[where + 1 :] if where >= 0 else []
    into = find_top(run, "INTO")
    tables = tables_in(run, skip_into=kind in ("SELECT_INTO", "FETCH", "DYNAMIC_SQL"))
    out = {"predicate_reads": [f for f in _fields(predicate, variables) if f not in tables], "writes": [], "targets": []}
    main = {"INSERT": "C", "UPDATE": "U", "DELETE": "D", "MERGE": "CU"}.get(kind)
    if kind == "DELETE" and not tables and len(run) > 1:
        tables = [dotted(run, 1)[0][-1].lower()]
    target = tables[0] if main and tables else None
    out["access"] = [{"table_name": target, "crud": m} for m in main] if target else []
    inner = tables_in(run[1:], skip_into=True) if main and kind != "DELETE" else tables
    out["access"] += [{"table_name": x, "crud": "R"} for x in inner if not (main and kind == "DELETE" and x == target)]
    read = run
    if kind == "UPDATE":
        put = find_top(run, "SET")
        parts = split_top(run[put + 1 : where if where >= 0 else len(run)]) if put >= 0 else []
        heads = [(p, find_top(p, "=")) for p in parts]
        out["writes"] = [t.text.lower() for p, eq in heads for t in ([p[eq - 1]] if eq > 0 and p[eq - 1].kind == "word" else p[:eq]) if eq > 0 and t.kind == "word"]
        read = [t for p, eq in heads for t in p[eq + 1 :]] + predicate
    elif kind == "INSERT" and into >= 0:
        _, at = dotted(run, into + 1)
        if at < len(run) and run[at].text == "(":
            end = closing(run, at)
            out["writes"], at = [t.text.lower() for t in run[at:end] if t.kind == "word"], end + 1
        read = run[at:]
    elif kind in ("SELECT_INTO", "FETCH", "DYNAMIC_SQL") and into >= 0:
        stop = find_top(run, "FROM", "USING", "LIMIT", start=into + 1)
        stop = stop if stop > 0 else len(run)
        out["targets"] = [".".join(dotted(p, 0)[0]) for p in split_top(run[into + 1 : stop]) if p[0].kind == "word"]
        read = run[:into] + run[stop:]
    out["sources"] = identifiers(read)
    out["reads"] = [f for f in _fields_of(out["sources"], variables) if f not in tables]
    return out


class _Reader:
    """Reads the objects of one file."""

    def __init__(self, text: str):
        self.text, self.tokens, self.at = text, tokens_of(text), 0
        self.words = [t.text if t.kind != "str" else "" for t in self.tokens]
        self.out: dict[str, list] = {name: [] for name in _ARRAYS}
        self.latest: dict[tuple, dict] = {}  # the last statement of each run of siblings, handlers apart
        self.arms: dict[tuple, dict] = {}  # of IF and CASE, by object and scope

    # -- tokens ---------------------------------------------------------------------------------------------------------
    def peek(self, ahead: int = 0) -> str:
        k = self.at + ahead
        return self.words[k] if k < len(self.words) else ""

    def line(self) -> int:
        return self.tokens[min(self.at, len(self.tokens) - 1)].line if self.tokens else 0

    def expect(self, *words: str) -> None:
        for word in words:
            if self.peek() != word:
                raise Unreadable(self.line(), f"{word} expected, {self.peek() or 'end'} found")
            self.at += 1

    def until(self, *words: str) -> list[Token]:
        """The run up to one of the words, which stays; CASE expressions and parentheses are passed over whole."""
        start, depth, cases, all_words = self.at, 0, 0, self.words
        for at in range(start, len(all_words)):
            word = all_words[at]
            if word in words and depth == 0 and cases == 0:
                self.at = at
                return self.tokens[start:at]
            if word == "(":
                depth += 1
            elif word == ")":
                depth -= 1
            elif word == "CASE":
                cases += 1
            elif word == "END" and cases:
                cases -= 1
            elif word == ";" and ";" not in words:
                self.at = at
                break
        else:
            self.at = max(start, len(all_words))
        raise Unreadable(self.line(), f"{' or '.join(words)} expected")

    def skip_unit(self) -> None:
        """To the next slash line or the next CREATE that opens a unit."""
        while self.at < len(self.tokens):
            if self.slash() or (self.peek() == "CREATE" and self.tokens[self.at - 1].text == ";"):
                return
            self.at += 1

    def slash(self) -> bool:
        t = self.tokens[self.at]
        before = self.text.rfind("\n", 0, t.start) + 1
        after = self.text.find("\n", t.end)
        return t.text == "/" and self.text[before : after if after >= 0 else len(self.text)].strip() == "/"

    # -- units ----------------------------------------------------------------------------------------------------------
    def read(self) -> dict[str, list]:
        while self.at < len(self.tokens):
            start = self.at
            if self.peek() == "CREATE":
                k = 1
                while self.peek(k) in ("OR", "REPLACE", "EDITIONABLE", "NONEDITIONABLE", "FORCE", "PUBLIC", "GLOBAL", "TEMPORARY", "UNIQUE", "BITMAP"):
                    k += 1
                if self.peek(k) in ("PROCEDURE", "FUNCTION", "PACKAGE", "TRIGGER"):
                    self.at += k
                    self.guarded(self.unit)
                    continue
            while self.at < len(self.tokens) and self.peek() != ";" and not self.slash():
                self.at += 1
            run = self.tokens[start : self.at]
            self.at += 1
            if run:
                try:
                    read_ddl(self.text, run, self.out)
                except (ValueError, IndexError) as e:
                    self.out["issues"].append({"type": "parse_error", "object_id": None, "line": run[0].line, "message": str(e)})
        return self.out

    def guarded(self, read) -> None:
        marks = {name: len(rows) for name, rows in self.out.items()}
        try:
            read()
        except (Unreadable, IndexError, RecursionError) as e:
            found = [o for o in self.out["objects"][marks["objects"] :]]
            line = getattr(e, "line", self.line())
            self.out["issues"].append({"type": "parse_error", "object_id": found[0]["object_id"] if found else None, "line": line, "message": str(e)})
            for o in found:
                o["parse_status"], o["end_line"] = "parse_error" if o["end_line"] is None else o["parse_status"], o["end_line"] or line
            self.skip_unit()

    def add_object(self, kind: str, owner: str, name: str, member: str | None, line: int) -> dict:
        made = {"object_id": f"{_PREFIX[kind]}-{owner}.{name}" + (f"::{member}" if member else ""), "type": kind, "owner": owner, "name": name, "member": member, "line": line, "end_line": None, "parse_status": "parsed", "return_type": None, "on_table": None}
        known = {o["object_id"] for o in self.out["objects"]}
        base, n = made["object_id"], 2
        while made["object_id"] in known:
            made["object_id"], n = f"{base}~{n}", n + 1
        self.out["objects"].append(made)
        return made

    def unit(self) -> None:
        kind, line = self.peek(), self.line()
        self.at += 1
        if kind == "PACKAGE" and self.peek() == "BODY":
            kind = "PACKAGE BODY"
            self.at += 1
        parts, self.at = dotted(self.tokens, self.at)
        if not parts:
            raise Unreadable(line, "name expected")
        made = self.add_object(kind, parts[0] if len(parts) > 1 else "", parts[-1], None, line)
        if self.peek() == "WRAPPED":
            made["parse_status"] = "skipped_wrapped"
            self.out["issues"].append({"type": "wrapped_object_skipped", "object_id": made["object_id"], "line": line, "message": f"{parts[-1]} is wrapped"})
            self.skip_unit()
            made["end_line"] = line
            return
        if kind == "TRIGGER":
            head = self.until("BEGIN", "DECLARE", "COMPOUND")
            on = find_top(head, "ON")
            made["on_table"] = dotted(head, on + 1)[0][-1] if on >= 0 else None
            self.routine_body(made, declared=self.peek() == "DECLARE")
        elif kind in ("PROCEDURE", "FUNCTION"):
            self.header(made)
            self.expect(self.peek() if self.peek() in ("IS", "AS") else "IS")
            self.routine_body(made)
        else:
            while self.peek() not in ("IS", "AS"):
                self.at += 1
                if self.at >= len(self.tokens):
                    raise Unreadable(line, "IS expected")
            self.at += 1
            self.declarations(made, package=True)
            if self.peek() == "BEGIN":
                self.routine_body(made)
            else:
                self.finish(made)

    def finish(self, made: dict) -> None:
        self.expect("END")
        if self.peek() != ";":
            _, self.at = dotted(self.tokens, self.at)
        self.expect(";")
        made["end_line"] = self.tokens[self.at - 1].line

    def header(self, made: dict) -> None:
        if self.peek() == "(":
            end = closing(self.tokens, self.at)
            for k, run in enumerate(split_top(self.tokens[self.at + 1 : end])):
                cut = find_top(run, "DEFAULT", ":=")
                core, default = (run[:cut], slice_of(self.text, run[cut + 1 :])) if cut >= 0 else (run, None)
                modes = [t.text for t in core[1:] if t.text in ("IN", "OUT")]
                kind = [t for t in core[1:] if t.text not in ("IN", "OUT", "NOCOPY")]
                self.out["parameters"].append({"object_id": made["object_id"], "position": k + 1, "name": core[0].text, "mode": " ".join(modes) or "IN", "type": slice_of(self.text, kind).upper(), "default": default})
            self.at = end + 1
        if self.peek() == "RETURN":
            start = self.at + 1
            while self.peek() not in ("IS", "AS", ";", "DETERMINISTIC", "PIPELINED", "AUTHID", "PARALLEL_ENABLE", "RESULT_CACHE"):
                self.at += 1
                if self.at >= len(self.tokens):
                    raise Unreadable(self.line(), "IS expected")
            made["return_type"] = slice_of(self.text, self.tokens[start : self.at]).upper()
        while self.peek() not in ("IS", "AS", ";") and self.at < len(self.tokens):
            self.at += 1

    def declarations(self, made: dict, package: bool = False) -> None:
        """Up to BEGIN or END; routines with a body become members."""
        while self.peek() not in ("BEGIN", "END"):
            if self.at >= len(self.tokens):
                raise Unreadable(self.line(), "BEGIN expected")
            word, line = self.peek(), self.line()
            if word in ("PROCEDURE", "FUNCTION"):
                self.at += 1
                name, start = self.peek(), self.at
                k, depth = start, 0
                while k < len(self.tokens) and not (depth == 0 and self.tokens[k].text in ("IS", "AS", ";")):
                    depth += (self.tokens[k].text == "(") - (self.tokens[k].text == ")")
                    k += 1
                if k >= len(self.tokens) or self.tokens[k].text == ";":
                    self.at = k + 1
                    continue
                self.at += 1
                member = self.add_object(made["type"] if package else word, made["owner"], made["name"], name, line)
                member["type"] = word
                self.header(member)
                self.at += 1
                self.routine_body(member)
                continue
            run = self.until(";")
            self.at += 1
            if word == "CURSOR":
                body = run[find_top(run, "IS") + 1 :]
                where = find_top(body, "WHERE")
                stop = find_top(body, "GROUP", "ORDER", "FOR", "CONNECT", start=where) if where >= 0 else -1
                predicate = slice_of(self.text, body[where + 1 : stop if stop > 0 else len(body)]) if where >= 0 else None
                self.out["cursors"].append({"object_id": made["object_id"], "name": run[1].text, "tables": tables_in(body), "predicate": predicate, "line": line})
            elif word not in ("PRAGMA", "TYPE", "SUBTYPE") and run and run[0].kind == "word":
                cut = find_top(run, ":=", "DEFAULT")
                kind = [t for t in (run[1:cut] if cut >= 0 else run[1:]) if t.text not in ("CONSTANT", "NOT", "NULL")]
                self.out["variables"].append({"object_id": made["object_id"], "name": word, "kind": "EXCEPTION" if kind and kind[0].text == "EXCEPTION" else "VARIABLE", "type": slice_of(self.text, kind).upper(), "line": line})

    # -- statements -----------------------------------------------------------------------------------------------------
    def routine_body(self, made: dict, declared: bool = True) -> None:
        if self.peek() == "DECLARE":
            self.at += 1
        if declared:
            self.declarations(made)
        self.object, self.seq = made, 0
        outer = self.out
        self.names = {v["name"] for v in outer["variables"] + outer["parameters"] if v["object_id"] == made["object_id"]}
        self.block([], [], 0)
        made["end_line"] = self.tokens[self.at - 1].line

    def add(self, kind: str, above: list[int], scope: list[str], depth: int, run: list[Token], **more) -> dict:
        self.seq += 1
        row = {
            "object_id": self.object["object_id"], "seq": self.seq, "parent": above[-1] if above else None, "ancestors": list(above), "scope_path": list(scope), "depth": depth, "type": kind, "line": run[0].line,
            "end_line": run[-1].line, "text": slice_of(self.text, run), "condition": None, "logical": 0, "sequences": 0, "access": _NONE, "writes": _NONE, "reads": _NONE, "predicate_reads": _NONE, "targets": _NONE, "sources": _NONE,
            "call_target": None, "handler_for": _NONE, "name": None, "requires_manual_review": kind == "DYNAMIC_SQL", "next": None, "opens": False, "arm_line": None,
        }
        row |= more
        within = scope[-1] if scope else ""
        arm = self.arms.get((row["object_id"], within))
        if arm is not None:
            row["arm_line"] = arm["line"]
            if kind == "RAISE" or row["call_target"] == "RAISE_APPLICATION_ERROR":
                arm["refuses"] = True
        if kind != "EXCEPTION_HANDLER":
            place = (row["object_id"], row["parent"], within)
            before = self.latest.get(place)
            if before is None:
                row["opens"] = True
            else:
                before["next"] = row["seq"]
            self.latest[place] = row
        self.out["statements"].append(row)
        return row

    def conditioned(self, run: list[Token]) -> dict:
        if not run:
            raise Unreadable(self.line(), "condition expected")
        count, runs = logic(run)
        return {"condition": slice_of(self.text, run), "logical": count, "sequences": runs, "sources": identifiers(run)}

    def arm(self, row: dict, arm: str, ordinal: int, line: int, run: list[Token] | None, kind: str | None = None, result: str | None = None) -> None:
        count, runs = logic(run or [])
        made = {"object_id": row["object_id"], "seq": row["seq"], "kind": kind or row["type"], "arm": arm, "ordinal": ordinal, "condition": slice_of(self.text, run) if run else None, "result": result, "line": line, "logical": count, "sequences": runs, "of": row["sources"][0] if row["sources"] else None, "refuses": False}
        self.out["arms"].append(made)
        if kind is None:
            self.arms[row["object_id"], f"{row['type']}#{row['seq']}.{arm}"] = made

    def body(self, above: list[int], scope: list[str], depth: int) -> None:
        while self.peek() not in _STOPS:
            if self.at >= len(self.tokens):
                raise Unreadable(self.line(), "END expected")
            self.statement(above, scope, depth)

    def block(self, above: list[int], scope: list[str], depth: int) -> None:
        """BEGIN ... EXCEPTION ... END; handlers are numbered after the main part."""
        self.expect("BEGIN")
        self.body(above, scope, depth)
        if self.peek() == "EXCEPTION":
            self.at += 1
            while self.peek() == "WHEN":
                start = self.at
                self.at += 1
                names = [t.text for t in self.until("THEN") if t.kind == "word" and t.text != "OR"]
                self.at += 1
                row = self.add("EXCEPTION_HANDLER", above, scope, depth, self.tokens[start : self.at], handler_for=names)
                self.body([*above, row["seq"]], [*scope, f"EXCEPTION#{row['seq']}.{'_'.join(names)}"], depth + 1)
                row["end_line"] = self.tokens[self.at - 1].line
        self.expect("END")
        if self.peek() != ";":
            self.at += 1
        self.expect(";")

    def statement(self, above: list[int], scope: list[str], depth: int) -> None:
        start, word = self.at, self.peek()
        if word == "<<":
            self.until(">>")
            self.at += 1
            return
        if word == "IF":
            self.at += 1
            run = self.until("THEN")
            row = self.add("IF", above, scope, depth, self.tokens[start : self.at + 1], **self.conditioned(run))
            self.arm(row, "THEN", 0, row["line"], run)
            below, name, k = [*above, row["seq"]], "THEN", 0
            self.at += 1
            while True:
                self.body(below, [*scope, f"IF#{row['seq']}.{name}"], depth + 1)
                if self.peek() == "ELSIF":
                    line, k = self.line(), k + 1
                    self.at += 1
                    run = self.until("THEN")
                    self.at += 1
                    name = f"ELSIF{k}"
                    self.arm(row, name, k, line, run)
                    row["sources"] += [x for x in identifiers(run) if x not in row["sources"]]
                elif self.peek() == "ELSE":
                    name = "ELSE"
                    self.arm(row, name, k + 1, self.line(), None)
                    self.at += 1
                else:
                    break
            self.expect("END", "IF", ";")
        elif word == "CASE":
            self.at += 1
            selector = self.until("WHEN")
            row = self.add("CASE", above, scope, depth, self.tokens[start : self.at + 1], sources=identifiers(selector), condition=slice_of(self.text, selector) or None)
            k = 0
            while self.peek() in ("WHEN", "ELSE"):
                line, name, run, k = self.line(), f"WHEN{k + 1}", None, k + 1
                if self.peek() == "WHEN":
                    self.at += 1
                    run = self.until("THEN")
                else:
                    name = "ELSE"
                self.at += 1
                self.arm(row, name, k, line, run)
                self.body([*above, row["seq"]], [*scope, f"CASE#{row['seq']}.{name}"], depth + 1)
            self.expect("END", "CASE", ";")
        elif word in ("LOOP", "WHILE", "FOR"):
            self.at += 1
            run = self.until("LOOP") if word != "LOOP" else []
            more = self.conditioned(run) if run else {}
            if word == "FOR":
                more |= {"targets": [run[0].text], "sources": identifiers(run[1:]), "name": run[0].text, "logical": 0, "sequences": 0, "access": [{"table_name": t, "crud": "R"} for t in tables_in(run)]}
            if word != "LOOP":
                self.at += 1
            row = self.add("LOOP", above, scope, depth, self.tokens[start : self.at], **more)
            if word == "FOR":
                self.names.add(run[0].text)
            self.body([*above, row["seq"]], [*scope, f"LOOP#{row['seq']}.BODY"], depth + 1)
            self.expect("END", "LOOP")
            if self.peek() != ";":
                self.at += 1
            self.expect(";")
        elif word in ("BEGIN", "DECLARE"):
            row = self.add("BLOCK", above, scope, depth, [self.tokens[start]])
            if word == "DECLARE":
                self.at += 1
                before = len(self.out["variables"])
                self.declarations(self.object)
                self.names |= {v["name"] for v in self.out["variables"][before:]}
            self.block([*above, row["seq"]], [*scope, f"BLOCK#{row['seq']}.BODY"], depth + 1)
        else:
            run = self.until(";")
            self.at += 1
            if run:
                self.leaf(run, above, scope, depth)
            return
        row["end_line"] = self.tokens[self.at - 1].line

    def leaf(self, run: list[Token], above: list[int], scope: list[str], depth: int) -> None:
        assign = find_top(run, ":=")
        kind = "ASSIGNMENT" if assign > 0 else _LEAVES.get(run[0].text, "CALL")
        more: dict = {}
        if kind == "ASSIGNMENT":
            target = ".".join(dotted(run, 1 if run[0].text == ":" else 0)[0])
            more = {"targets": [target], "sources": identifiers(run[assign + 1 :])}
        elif kind in ("SELECT_INTO", "INSERT", "UPDATE", "DELETE", "MERGE", "FETCH", "DYNAMIC_SQL", "FORALL"):
            more = _dml(kind, run, self.names)
        elif kind == "CALL":
            parts, _ = dotted(run, 0)
            more = {"call_target": ".".join(parts), "sources": identifiers(run)}
        elif kind in ("EXIT", "CONTINUE"):
            when = find_top(run, "WHEN")
            more = self.conditioned(run[when + 1 :]) if when >= 0 else {}
        elif kind in ("RAISE", "SAVEPOINT", "ROLLBACK", "OPEN_CURSOR", "CLOSE_CURSOR"):
            more = {"name": run[-1].text if len(run) > 1 else None}
        elif kind == "RETURN":
            more = {"sources": identifiers(run[1:])}
        row = self.add(kind, above, scope, depth, run, **more)
        self.case_arms(run, row)

    def case_arms(self, run: list[Token], row: dict) -> None:
        """The arms of the CASE expressions of a statement, each with its own line."""
        at, n, k = [i for i, t in enumerate(run) if t.text == "CASE" and t.kind == "word"], 0, 0
        for first in at:
            if first < k:
                continue  # inside the one before
            k = first
            end, depth = k + 1, 1
            while end < len(run) and depth:
                depth += (run[end].text == "CASE") - (run[end].text == "END")
                end += 1
            marks, depth = [], 0
            for j in range(k + 1, end):
                depth += (run[j].text == "CASE") - (run[j].text == "END" and j < end - 1)
                if depth == 0 and run[j].kind == "word" and run[j].text in ("WHEN", "THEN", "ELSE"):
                    marks.append(j)
            selector = slice_of(self.text, run[k + 1 : marks[0]]) if marks else ""
            stops = [*marks, end - 1]
            for i, j in enumerate(marks):
                if run[j].text == "THEN":
                    continue
                n += 1
                is_else = run[j].text == "ELSE"
                condition = None if is_else else run[j + 1 : stops[i + 1]]
                result = slice_of(self.text, run[j + 1 : stops[i + 1]] if is_else else run[stops[i + 1] + 1 : stops[min(i + 2, len(stops) - 1)]])
                self.arm(row, "ELSE" if is_else else f"WHEN{n}", n, run[j].line, condition, "CASE_EXPRESSION", result)
                if condition and selector:
                    self.out["arms"][-1]["condition"] = f"{selector} = {self.out['arms'][-1]['condition']}"
            k = end


def facts_of(text: str | None) -> dict[str, list]:
    """All facts of one text; an empty or null text has none."""
    return _Reader(text or "").read()


def read_facts(files: DataFrame) -> DataFrame:
    """(file, text) -> one row for each file with an array of structs for each kind of fact.

    Reading costs far more than moving a source text, so the files are dealt over as many tasks as the session's shuffles
    have, whatever the scan's splits are.
    """
    spark = files.sparkSession
    schema = spark.createDataFrame([], FACTS_SCHEMA).schema
    types = {f.name: to_arrow_type(f.dataType) for f in schema.fields}
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (batch.slice(lo, FILES) for batch in batches for lo in range(0, batch.num_rows, FILES)):
            gc.disable()  # facts hold no cycles; looking for some would take a fifth of the time
            try:
                rows = [facts_of(t) for t in part.column(1).to_pylist()]
            finally:
                gc.enable()
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([r[name] for r in rows], types[name]) for name in _ARRAYS)], names=list(types))

    return files.select("file", "text").repartition(tasks, "file").mapInArrow(read, schema)
