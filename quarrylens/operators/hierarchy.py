"""Hierarchical queries: CONNECT BY with START WITH, LEVEL, root, path, leaves, cycles and the orders of SEARCH and SIBLINGS.

A table of (id, parent) is walked level by level. Rows are first numbered along the order of siblings, by ranges, so that no parent,
however many children it has, must fit in a task; the edges are written narrow, and each level is one join of the last level's
written frontier with them (broadcast while the frontier is small, as Spark knows the size of what was written). A row occurs once for each way that leads to
it. An occurrence is named by the numbers of the rows on its way, which also are its place in depth-first order. Other columns
join at the end, by number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.cut import row_numbers, settled

DEPTH, BREADTH = "depth", "breadth"
ADDED = ("level", "root", "path", "is_leaf", "is_cycle", "place")


def connect_by(
    rows: DataFrame, id: str, parent: str, start_with: Column, siblings: list[Column] | None = None, nocycle: bool = False, search: str | None = None, most_levels: int | None = None, edges: DataFrame | None = None
) -> DataFrame:
    """rows reached from those of start_with by `PRIOR id = parent`, with level, root (its id), path (ids from the root), is_leaf, is_cycle and, with search, place.

    siblings orders the rows of one parent (sort expressions; ids in the end), search numbers all rows from 1, depth first or breadth first. edges, if
    given, holds further (id, parent) pairs besides those of rows. A row that has a child among its own ancestors (itself included) is a
    cycle: an error, unless nocycle, which leaves that child out and marks the row. Null ids and parents join nothing; start_with is false where null. Added
    names that rows already has take underscores.
    """
    names = {}
    for name in ADDED:
        names[name] = name
        while names[name] in rows.columns:
            names[name] += "_"
    marked = rows.withColumn("_start", F.coalesce(start_with, F.lit(False)))
    numbered = settled(row_numbers(marked, [*(siblings or []), F.asc(id), F.asc(parent)], "_seat"))
    numbered = numbered.select(F.struct(*[F.col(c) for c in rows.columns]).alias("_row"), F.col(id).alias("_id"), F.col(parent).alias("_parent"), "_start", "_seat")
    links = numbered.select("_seat", "_id", "_parent").filter("_parent is not null")
    if edges is not None:
        more = numbered.select("_seat", "_id").join(edges.select(F.col(id).alias("_id"), F.col(parent).alias("_parent")), "_id").select("_seat", "_id", "_parent")
        links = links.unionByName(more.filter("_parent is not null"))
    links = settled(links)
    ids = F.array("_id")
    frontier = settled(numbered.filter("_start").select("_seat", "_id", F.lit(1).alias("level"), F.col("_id").alias("root"), ids.alias("path"), F.array("_seat").alias("way"), F.lit(False).alias("loop")))
    levels = [frontier]
    while (most_levels is None or len(levels) < most_levels) and not frontier.isEmpty():
        above = frontier.select(F.col("_id").alias("_parent"), "level", "root", "path", "way")
        step = links.join(above, "_parent")
        step = step.select("_seat", "_id", (F.col("level") + 1).alias("level"), "root", F.concat("path", ids).alias("path"), F.concat("way", F.array("_seat")).alias("way"), F.coalesce(F.array_contains("path", F.col("_id")), F.lit(False)).alias("loop"))
        reached = settled(step)
        levels.append(reached)
        frontier = reached.filter("not loop")
    everything = levels[0]
    for level in levels[1:]:
        everything = everything.unionByName(level)
    everything = settled(everything)
    if not nocycle and not everything.filter("loop").isEmpty():
        raise ValueError("CONNECT BY loop in the rows")
    below = everything.filter("level > 1").select(F.slice("way", 1, F.col("level") - 1).alias("way"), "loop").groupBy("way").agg(F.bool_or("loop").alias("is_cycle"), F.bool_or(~F.col("loop")).alias("inner"))
    found = everything.filter("not loop").join(below, "way", "left").withColumn("is_leaf", ~F.coalesce("inner", F.lit(False))).withColumn("is_cycle", F.coalesce("is_cycle", F.lit(False)))
    if most_levels is not None:  # what lies below the last level was not looked for
        deeper = links.select(F.col("_parent").alias("_id")).distinct()
        found = found.join(deeper.withColumn("deeper", F.lit(True)), "_id", "left").withColumn("is_leaf", F.when(F.col("level") < most_levels, F.col("is_leaf")).otherwise(F.col("deeper").isNull())).drop("deeper")
    if search:
        found = row_numbers(found, [F.asc("way")] if search == DEPTH else [F.asc("level"), F.asc("way")], "place")
    shown = [n for n in ADDED if n != "place" or search]
    return found.join(numbered.select("_seat", "_row"), "_seat").select("_row.*", *[F.col(n).alias(names[n]) for n in shown])

