"""A check of figures as they are written: every line of a text is read as a head, a node, an edge or a state, and what can't be is a fault.

Lines are rows, so a figure of any size is checked by many tasks; ends of edges meet the nodes of the same figure.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import language as la

HEADS = ("flowchart TD", "stateDiagram-v2")
#: A flow's node: a name and a quoted label in one of the shapes.
SHAPES = (('{"', '"}'), ('[/"', '"/]'), ('[["', '"]]'), ('(["', '"])'), ('[("', '")]'), ('("', '")'), ('["', '"]'))
_ANY = "|".join(f"{re.escape(a)}(?:.*){re.escape(b)}" for a, b in SHAPES)
NODE = rf"^\s+(\w+)(?:{_ANY})\s*$"
LABEL = r'^\s+\w+[^"]*"(.*)"[^"]*$'
EDGE = r'^\s+(\w+|\[\*\])\s+(?:-->|-\.->)(?:\|"(.*)"\|)?\s+(\w+|\[\*\])(?:\s*:.*)?$'
STATE = r"^\s+(\w+)\s*$"


def _captured(line: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(line, pattern, group)


def read(texts: DataFrame, keys: list[str], text: str = "mermaid") -> DataFrame:
    """keys, number, line, kind (head, node, edge, state or none) and the names and label that a line has."""
    lines = texts.select(*keys, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("number", "line"), F.substring_index(text, "\n", 1).alias("head"))
    flow, line = F.col("head") == HEADS[0], F.col("line")
    kind = (
        F.when(F.col("number") == 0, F.when(line.isin(*HEADS), "head").otherwise("none")).when(F.trim(line) == "", "blank").when(line.rlike(EDGE), "edge")
        .when(flow & line.rlike(NODE), "node").when(~flow & line.rlike(STATE), "state").otherwise("none")
    )
    out = lines.select(*keys, "number", "line", kind.alias("kind"))
    label = F.when(F.col("kind") == "node", _captured(line, LABEL, 1)).when(F.col("kind") == "edge", F.nullif(_captured(line, EDGE, 2), F.lit("")))
    name = F.when(F.col("kind") == "node", _captured(line, NODE, 1)).when(F.col("kind") == "state", _captured(line, STATE, 1))
    return out.select("*", name.alias("symbol"), label.alias("label"), *[F.when(F.col("kind") == "edge", _captured(line, EDGE, g)).alias(n) for g, n in ((1, "source"), (3, "target"))])


def faults(texts: DataFrame, keys: list[str], text: str = "mermaid") -> DataFrame:
    """keys, number (of the line, from 0), fault. A figure without any is fit to be written."""
    rows = read(texts, keys, text)
    bad = lambda when, fault: F.when(when, F.struct(F.lit(None).cast("string").alias("symbol"), F.lit(False).alias("names"), F.lit(fault).alias("fault")))
    use = lambda when, symbol, names: F.when(when, F.struct(symbol.alias("symbol"), F.lit(names).alias("names"), F.lit(None).cast("string").alias("fault")))
    none, edge, label = F.col("kind") == "none", F.col("kind") == "edge", F.col("label")
    events = F.array(
        bad(none & (F.col("number") == 0), "no head"), bad(none & (F.col("number") > 0), "line not understood"), bad((F.col("kind") == "node") & (F.trim("label") == ""), "node without a label"), bad(label.contains('"'), "quote inside a label"), bad(label.rlike(la.INTERNAL), "internal name in a label"),
        use(F.col("symbol").isNotNull(), F.col("symbol"), True), *[use(edge & (F.col(end) != "[*]"), F.col(end), False) for end in ("source", "target")],
    )
    # What a line says and what it names go through the figures once; names and ends of one figure meet in its own windows.
    at = rows.select(*keys, "number", F.explode(F.array_compact(events)).alias("e")).select(*keys, "number", "e.*")
    same = Window.partitionBy(*keys, "symbol")
    at = at.withColumn("n", F.count_if("names").over(same)).withColumn("first", F.min(F.when(F.col("names"), F.col("number"))).over(same))
    named = F.when(F.col("symbol").isNull(), F.col("fault")).when(~F.col("names") & (F.col("n") == 0), "edge without an end").when(F.col("names") & (F.col("n") > 1) & (F.col("number") == F.col("first")), "name used twice")
    return at.select(*keys, "number", named.alias("fault")).filter("fault IS NOT NULL").dropDuplicates([*keys, "number", "fault"])
