"""Merkle manifest of a table: a digest of all rows by source, and for each row the siblings that prove it.

A row's leaf is a digest of its named columns. Leaves are sorted by source and id into range parts written as Parquet, so the
sort spills and no source has to fit anywhere. The node store has a folder for each level; its rows are runs of at most 16
siblings, named by tree and number. A level is made from the one before by a scan of its runs in order, each giving one node,
and stops where a tree has one node left. The sources' roots are the leaves of one more tree, whose root is the manifest's.

Proofs are taken by coordinate: from the root down, each level's runs are merge-joined with the paths of the runs above them
(tree and number of the run are the parent's coordinate), so a node costs its siblings and its parent's path, never a walk.

Cases: a null column is written `-` in its leaf, so it differs from an empty text; null sources are one source, before the
others; null ids come first; rows alike in source and id are ordered by their leaves, and rows alike in all columns have equal
leaves and stand in any order; texts of any length; an empty table has no rows and no root. Other columns of the input, clashing
names included, are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import Scratch, in_order, places

FAN_OUT = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as a leaf holds it: `-` for null, else its bytes' number, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def tampered_text(doc_id: Column, text: Column) -> Column:
    """The audit's tampering: A-Z lower-cased in the texts of every fifth id by crc32; null where a text is left alone."""
    return F.when(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.translate(text, _UPPER, _LOWER))


@dataclass
class Manifest:
    """The node store, all of it written tables. A level's rows are runs of siblings, (tree, run, n, nodes); n counts the level's nodes in the tree.

    runs is the leaves' level, with `members` of (number, leaf, doc_id, altered) in place of nodes; levels are those above it, lowest
    first; subroots has (tree, source, hash); top are the levels of the tree over the sources; root is None for an empty table.
    """

    scratch: Scratch
    runs: DataFrame
    levels: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]
    root: str | None


def _runs(nodes: DataFrame, member: Column) -> DataFrame:
    """Runs of siblings in order of their coordinates. The range parts that sort them serve the grouping too; a group has at most 16 rows."""
    dealt = nodes.select("tree", F.floor(F.col("number") / FAN_OUT).cast("long").alias("run"), "n", member.alias("member")).repartitionByRange("tree", "run")
    return dealt.groupBy("tree", "run").agg(F.first("n").alias("n"), F.sort_array(F.collect_list("member")).alias("members")).sortWithinPartitions("tree", "run")


def _parents(level: DataFrame, hashes: Column) -> DataFrame:
    """The nodes over a level's runs, one from each by a scan in order."""
    return level.select("tree", F.col("run").alias("number"), F.ceil(F.col("n") / FAN_OUT).cast("long").alias("n"), F.sha2(F.array_join(hashes, ""), 256).alias("hash"))


def _climb(scratch: Scratch, nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The levels from nodes (tree, number, n, hash) upwards, and (tree, hash) of every tree's last node."""
    levels, roots = [], nodes.filter("n = 1").select("tree", "hash")
    while nodes.filter("n > 1").limit(1).count():
        runs = _runs(nodes.filter("n > 1"), F.struct("number", "hash")).select("tree", "run", "n", F.col("members.hash").alias("nodes"))
        levels.append(scratch.table(runs, f"{name}/level={len(levels)}"))
        nodes = _parents(levels[-1], F.col("nodes"))
        roots = roots.unionByName(nodes.filter("n = 1").select("tree", "hash"))
    return levels, roots


def build(docs: DataFrame, altered_text=None) -> Manifest:
    """The manifest of docs. altered_text(doc_id, text), if given, names a text to be held against the manifest instead of a row's own, null for none."""
    scratch, values = Scratch(docs.sparkSession), [F.col(c) for c in COLUMNS]
    altered = F.lit(None).cast("string")
    if altered_text:
        other = altered_text(F.col("doc_id"), F.col("text"))
        altered = F.when(other.isNotNull(), leaf_of(*values[:-1], other))
    leaves = docs.select("doc_id", F.col("source").cast("string").alias("source"), leaf_of(*values).alias("leaf"), altered.alias("altered"))
    placed = places(in_order(scratch, leaves, [F.asc_nulls_first("source"), F.asc_nulls_first("doc_id"), F.asc("leaf")], "leaves")).withColumn("part", F.shiftright("at", 33))
    # A stretch is what a part has of a source. Trees are numbered along the order, and a tree starts where its first stretch does.
    stretches = scratch.table(placed.groupBy("part", "source").agg(F.min("place").alias("lo"), F.count(F.lit(1)).alias("rows")), "stretches")
    trees = in_order(scratch, stretches.groupBy("source").agg(F.min("lo").alias("start"), F.sum("rows").alias("n")), [F.asc_nulls_first("source")], "trees")
    trees = scratch.table(places(trees).select("source", F.col("place").alias("tree"), "start", "n"), "numbered")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    of_part = stretches.join(trees, same(stretches, trees)).select("part", stretches["source"], "tree", "start", "n").alias("s")
    # No key of this join has more rows than a part of the sort has.
    nodes = placed.alias("p").join(of_part, (F.col("p.part") == F.col("s.part")) & F.col("p.source").eqNullSafe(F.col("s.source")))
    nodes = nodes.select("tree", (F.col("place") - F.col("start")).alias("number"), "n", "doc_id", "leaf", "altered")
    runs = scratch.table(_runs(nodes, F.struct("number", "leaf", "doc_id", "altered")), "leaf-runs")
    levels, roots = _climb(scratch, _parents(runs.filter("n > 1"), F.col("members.leaf")), "nodes")
    roots = roots.unionByName(runs.filter("n = 1").select("tree", F.col("members")[0]["leaf"].alias("hash")))
    subroots = scratch.table(roots.join(trees, "tree").select("tree", "source", "hash"), "subroots")
    count = subroots.count()
    top, last = _climb(scratch, subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("number"), F.lit(count).cast("long").alias("n"), "hash"), "top")
    root = last.first()
    scratch.drop("leaves", "stretches", "trees", "numbered")
    return Manifest(scratch, runs, levels, subroots, top, root and root.hash)


def siblings(nodes: Column, k: Column) -> Column:
    return F.struct(F.array_join(F.slice(nodes, F.lit(1), k), "").alias("before"), F.array_join(F.slice(nodes, k + 2, F.lit(FAN_OUT)), "").alias("after"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["before"], node, step["after"]))


def path_digest(path: Column) -> Column:
    """One digest of all siblings of a path, from the leaf's own up to the root's, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""), 256)


def _paths(level: DataFrame, above: DataFrame, ends: DataFrame) -> DataFrame:
    """A level's runs with `path` and `subroot` of the node over them: a tree's only run has those of the tree's end, the others merge with the level above."""
    inner = level.filter(f"n > {FAN_OUT}").join(above.select("tree", F.col("number").alias("run"), "path", "subroot"), ["tree", "run"]) if above is not None else None
    last = level.filter(f"n <= {FAN_OUT}").join(ends.select("tree", "path", "subroot"), "tree")
    return last if inner is None else last.unionByName(inner)


def _below(with_paths: DataFrame) -> DataFrame:
    """(tree, number, path, subroot) of a level's nodes: a node's own siblings, then the path of the node above."""
    each = with_paths.select("tree", "run", "nodes", "path", "subroot", F.posexplode("nodes").alias("k", "hash"))
    return each.select("tree", (F.col("run") * FAN_OUT + F.col("k")).alias("number"), F.concat(F.array(siblings(F.col("nodes"), F.col("k"))), F.col("path")).alias("path"), "subroot")


def proofs(m: Manifest) -> DataFrame:
    """(doc_id, tree, number, leaf, altered, subroot, root, path), a row for each row of the table; path has the siblings from the leaf up to the root."""
    none = F.array().cast(_PATH)
    start = m.subroots.sparkSession.range(1).select(F.lit(0).cast("long").alias("tree"), none.alias("path"), F.lit("").alias("subroot"))
    above = None
    for level in reversed(m.top):
        above = _below(_paths(level, above, start))
    if above is None:  # at most one source, whose root is the root
        ends = m.subroots.select("tree", none.alias("path"), F.col("hash").alias("subroot"))
    else:
        ends = m.subroots.join(above.select(F.col("number").alias("tree"), "path"), "tree").select("tree", "path", F.col("hash").alias("subroot"))
    ends, above = m.scratch.table(ends, "ends"), None
    for k, level in reversed(list(enumerate(m.levels))):
        above = m.scratch.table(_below(_paths(level, above, ends)), f"paths/level={k}")
    leaves = _paths(m.runs, above, ends).select("tree", "n", "path", "subroot", F.col("members.leaf").alias("nodes"), F.explode("members").alias("m"))
    own = F.when(F.col("n") > 1, F.array(siblings(F.col("nodes"), (F.col("m.number") % FAN_OUT).cast("int")))).otherwise(none)
    return leaves.select("m.doc_id", "tree", "m.number", "m.leaf", "m.altered", "subroot", F.lit(m.root).cast("string").alias("root"), F.concat(own, F.col("path")).alias("path"))


def audit(docs: DataFrame, altered_text=tampered_text) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): every row's proof, held against the altered text where there is one."""
    found = proofs(build(docs, altered_text)).withColumn("folded_root", fold(F.coalesce("altered", "leaf"), F.col("path")))
    return found.select("doc_id", "leaf", "subroot", "root", path_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
