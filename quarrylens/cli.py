"""The stages as shell commands: `python -m quarrylens.cli STAGE --source FOLDER --out FOLDER`, each with its statistics and an exit code.

0: done. 1: bad input, or figures that are unfit. 2: a question that is refused. With `--source` a stage reads the source tree and writes
its tables as a run (`sources/runs`); without it, it works from the runs below `--out`: the parser's is required, what rests on
another that is absent is left out and the run is named.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from .plans import diagrams as dg, document as do, graph as gr, rules as ru, stages as st
from .plans.code import Code
from .sources import inventory as inv, runs

STAGES = ("inventory", "parser", "data", "logic", "rules", "diagrams", "document", "graph", "ask")


def statistics(tables: dict[str, DataFrame]) -> dict[str, int]:
    """Rows of each table."""
    return {name: df.count() for name, df in tables.items()}


def run(spark: SparkSession, args: argparse.Namespace, say=print) -> int:
    if not args.source:
        return from_runs(spark, args, say)
    files = inv.discover(spark, args.source)
    if not files.limit(1).count():
        say(f"no .sql file below {args.source}")
        return runs.EXIT_INVALID
    if args.stage in ("inventory", "parser", "data", "logic", "rules"):
        tables = st.inventory_tables(files) if args.stage == "inventory" else st.tables_of(Code.of(spark, args.source), args.stage)
        version = runs.write_run(spark, args.out, args.stage, tables)
        written = {name: runs.load_run(spark, args.out, args.stage, name, version) for name in tables}
        say(json.dumps({"stage": args.stage, "run_version": version, "rows": statistics(written)}))
        return runs.EXIT_OK
    if args.stage == "ask" and not gr.fitting(args.question or ""):  # refused before anything is read
        say(json.dumps({"refused": gr.NO_FIT, "suggestions": [i[1] for i in gr.INTENTS]}))
        return runs.EXIT_REFUSED
    code = Code.of(spark, args.source)
    if args.stage in ("diagrams", "document"):
        rules = ru.rules(code)
        flows = dg.flows(code, rules)
        try:
            dg.write_diagrams(flows, code, f"{args.out}/diagrams")
        except ValueError as unfit:
            say(str(unfit))
            return runs.EXIT_INVALID
        say(json.dumps({"stage": "diagrams", "quality": dg.quality(flows).first().asDict()}))
        if args.stage == "document":
            index = do.build_index(code, rules, flows, do.annotations(spark, args.annotations))
            document = do.blocks(code, flows, index)
            broken = do.broken_links(document).count()
            do.write_document(document, index, f"{args.out}/document")
            say(json.dumps({"stage": "document", "requirements": index.requirements.count(), "gaps": index.gaps.count(), "broken_links": broken}))
            return runs.EXIT_INVALID if broken else runs.EXIT_OK
        return runs.EXIT_OK
    return answer(gr.build(code), args, say, [])


def answer(g: gr.Graph, args: argparse.Namespace, say, absent: list[str]) -> int:
    """The graph written, or asked a question."""
    if args.stage == "graph":
        gr.write_tables(g, f"{args.out}/graph")
        gr.load_script(g).select("line").write.mode("overwrite").text(f"{args.out}/graph/load")
        say(json.dumps({"stage": "graph", "nodes": g.nodes.count(), "edges": g.edges.count(), "absent": absent, "dropped": g.dropped.agg(F.sum("dropped")).first()[0] or 0}))
        return runs.EXIT_OK
    found = gr.ask(g, args.question or "")
    if not found["ok"]:
        say(json.dumps({"refused": found["reason"], "suggestions": found["suggestions"]}))
        return runs.EXIT_REFUSED
    rows = found["answer"].limit(args.rows)
    say(json.dumps({"intent": found["intent"], "subject": found["subject"], "rows": [r.asDict() for r in rows.collect()]}, default=str))
    return runs.EXIT_OK


def from_runs(spark: SparkSession, args: argparse.Namespace, say=print) -> int:
    """A stage over the runs of the stages before it."""
    if args.stage in ("inventory", "parser", "data"):
        say(f"{args.stage} reads the source: --source is needed")
        return runs.EXIT_INVALID
    if args.stage == "ask" and not gr.fitting(args.question or ""):
        say(json.dumps({"refused": gr.NO_FIT, "suggestions": [i[1] for i in gr.INTENTS]}))
        return runs.EXIT_REFUSED
    at = st.Artefacts(spark, args.out, leave_out=(args.stage,))
    if args.stage in ("logic", "rules"):
        tables = st.tables_of(at, args.stage)
    elif args.stage in ("diagrams", "document"):
        rules = st.rules_of(at)
        flows = dg.flows(at, rules)
        tables = st.diagram_tables(at, flows) if args.stage == "diagrams" else st.document_tables(do.build_index(at, rules, flows, do.annotations(spark, args.annotations)))
    else:
        return answer(gr.build(at, st.parts(at)), args, say, at.absent)
    version = runs.write_run(spark, args.out, args.stage, tables)
    say(json.dumps({"stage": args.stage, "run_version": version, "absent": at.absent, "rows": statistics({n: runs.load_run(spark, args.out, args.stage, n, version) for n in tables})}))
    return runs.EXIT_OK


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quarrylens", description=__doc__)
    parser.add_argument("stage", choices=STAGES)
    parser.add_argument("question", nargs="?")
    parser.add_argument("--source", help="the source tree; without it the stage works from the runs below --out")
    parser.add_argument("--out", default="output")
    parser.add_argument("--annotations")
    parser.add_argument("--rows", type=int, default=100, help="rows of an answer that are shown")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"quarrylens {args.stage}").getOrCreate()
    try:
        return run(spark, args)
    except (PySparkException, FileNotFoundError, ValueError) as bad:
        print(f"{args.stage}: {str(bad).splitlines()[0]}", file=sys.stderr)
        return runs.EXIT_INVALID


if __name__ == "__main__":
    sys.exit(main())
