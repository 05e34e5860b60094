"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, the source's target over its size. Along a fixed order
of the source's documents these are summed, one random offset is added, and a document is emitted once for each integer
that its stretch of the sum crosses: the floor or the ceiling of its expected copies. The order is by size and then by a
keyed digest, so that every size class is thinned or repeated evenly and the words taken come near the target.

The prefix sum is a rank times the expected copies. Ranks come from one range partitioning of narrow rows by source, size,
digest and place of storage: a row's rank is its number within its part plus the rows of its source in earlier parts, of which
only a part's first source can have any. No source, size or id has to fit in a task. Sources, which may be many, are numbered
in the same way, and the level of the targets is found by repeated sums over them, none of which orders them in one place.

Cases: a null text has size 0; a null source is a source, after the others; documents of size 0 take nothing, but have a
rank; a source without words takes nothing; rows alike in id, source and text (null ids too) have consecutive ranks and give
the same rows in whatever order; an empty table gives no rows. Other columns of the input are ignored by `mix` and kept by
`mixed_documents`, whose choice among rows alike in all columns has no effect.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import SPACE, Scratch, hot_keys, split_join, tasks_of


@dataclass(frozen=True)
class MixParams:
    weights: tuple[int, ...] = (3, 1, 2)  # of the sources in code point order, repeating
    share_percent: int = 150  # of all sizes that the mix takes
    most_copies: int = 2
    seed: str = "mix"
    tasks: int = 0  # range parts; 0: as many as shuffles have


def text_size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def _parted(df: DataFrame, scratch: Scratch, name: str, order: list[Column], tasks: int) -> DataFrame:
    """df written in range parts of an order, with `part`, the number of a row's part."""
    n = tasks or tasks_of(df.sparkSession)
    parts = df.repartitionByRange(n, *order).select("*", F.spark_partition_id().alias("part"))
    return scratch.table(parts, name)


def source_targets(sizes: DataFrame, p: MixParams, scratch: Scratch) -> DataFrame:
    """(source, source_size, num, den, target): targets by weight, none above most_copies times its source's size.

    Sources whose share at the current level would exceed their bound are capped and the rest reshared, until no source is
    added: as many sums as there are such rounds. target is num / den, both whole numbers, so that it is rounded once.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_source = _parted(by_source, scratch, "sources", [F.asc_nulls_last("source")], p.tasks)
    counts = {r.part: r.n for r in by_source.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each part
    before, starts = 0, []
    for part in sorted(counts):
        starts.append((part, before))
        before += counts[part]
    earlier = F.broadcast(sizes.sparkSession.createDataFrame(starts, "part int, earlier long"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.asc_nulls_last("source")))
    weight = F.element_at(F.lit(list(p.weights)), ((F.col("earlier") + F.col("place") - 1) % len(p.weights) + 1).cast("int")).cast("long")
    rows = by_source.withColumn("place", place).join(earlier, "part").select("source", "source_size", weight.alias("weight"))
    rows = scratch.table(rows, "weights")
    # Level: every uncapped source takes weight * left / (100 * left_weight) words.
    wide = lambda x: F.lit(x).cast("decimal(19,0)")
    everything = rows.agg(F.sum("source_size")).first()[0] or 0
    capped, left, left_weight, known = F.lit(False), everything * p.share_percent, 0, -1
    while True:
        r = rows.agg(F.sum(F.when(capped, F.col("source_size"))).alias("size"), F.sum(F.when(~capped, F.col("weight"))).alias("weight"), F.count_if(capped).alias("n")).first()
        left, left_weight = everything * p.share_percent - (r.size or 0) * 100 * p.most_copies, r.weight or 0
        if r.n == known or not left_weight:
            break
        known = r.n
        capped = F.col("weight").cast("decimal(12,0)") * wide(left) >= wide(left_weight) * (F.col("source_size") * (100 * p.most_copies)).cast("decimal(19,0)")
    num = F.when(capped, F.col("source_size") * p.most_copies).otherwise(F.col("weight") * F.lit(left))
    den = F.when(capped, F.lit(1)).otherwise(F.lit(left_weight * 100))
    return rows.select("source", "source_size", num.alias("num"), den.cast("long").alias("den"), (num.cast("double") / den.cast("double")).alias("target"))


def _digest(p: MixParams, *parts: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(p.seed), *[F.coalesce(x.cast("string"), F.lit("")) for x in parts]))


def copies(rank: Column, target: Column, source_size: Column, offset: Column) -> Column:
    """Integers crossed by the rank-th stretch of expected copies, from 1. offset is a multiple of 2**-20 in [0, 1)."""
    expected = target / source_size.cast("double")
    return F.when(source_size == 0, F.lit(0)).otherwise(F.floor(expected * rank + offset) - F.floor(expected * (rank - 1) + offset)).cast("long")


def mix(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken), a row for each row of docs."""
    return _mixed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text"), params).drop("key")


def _mixed(docs: DataFrame, p: MixParams, key: Column | None = None) -> DataFrame:
    """mix with `key`, a column of docs that tells apart rows which the digest doesn't."""
    scratch = Scratch(docs.sparkSession)
    sized = docs.select("doc_id", "source", text_size(F.col("text")).alias("size"), _digest(p, F.col("doc_id"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))).alias("digest"), (F.lit(0).cast("long") if key is None else key).alias("key"))
    sized = scratch.table(sized, "sized")
    targets = scratch.table(source_targets(sized, p, scratch), "targets")
    order = [F.asc_nulls_last("source"), F.asc("size"), F.asc("digest"), F.asc("key"), F.asc("tie")]
    # Rows alike in all but `tie` give the same output rows whichever comes first; it only deals them out.
    tied = sized.select("*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("tie"))
    parts = _parted(tied, scratch, "parts", order, p.tasks)
    # The first source of a part, if it began in an earlier one: fewer rows than parts.
    runs = parts.groupBy("part", "source").agg(F.count(F.lit(1)).alias("n"))
    heads = parts.groupBy("part").agg(F.min(F.struct(F.col("source").isNull().alias("none"), "source")).alias("low"), F.max(F.struct(F.col("source").isNull().alias("none"), "source")).alias("high"))
    heads = heads.select("part", F.col("low.source").alias("low"), F.col("high.source").alias("high"))
    ends = F.broadcast(heads)  # a row for each part
    tails = runs.join(ends, "part").filter(F.col("source").eqNullSafe(F.col("low")) | F.col("source").eqNullSafe(F.col("high"))).select("part", "source", "n")
    over = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = tails.withColumn("earlier", F.coalesce(F.sum("n").over(over), F.lit(0))).filter("earlier > 0").select(F.col("part").alias("e_part"), F.col("source").alias("e_source"), "earlier")
    within = Window.partitionBy("part", "source").orderBy("size", "digest", "key", "tie")
    ranked = parts.withColumn("place", F.row_number().over(within))
    ranked = ranked.join(F.broadcast(earlier), (F.col("part") == F.col("e_part")) & F.col("source").eqNullSafe(F.col("e_source")), "left")
    ranked = ranked.select("doc_id", "source", "size", "key", (F.coalesce("earlier", F.lit(0)) + F.col("place")).alias("rank"))
    # Targets by source: a source may hold most rows, so their join is split.
    by = lambda df: df.withColumn("source_key", F.coalesce(F.concat(F.lit("v"), "source"), F.lit("n")))
    hot = hot_keys(by(parts.groupBy("source").agg(F.count(F.lit(1)).alias("n"))), ["source_key"], "n", parts.count())
    ranked = split_join(by(ranked), by(targets).drop("source"), ["source_key"], "inner", hot, F.col("rank")).drop("source_key")
    offset = F.conv(F.substring(_digest(p, F.lit("offset"), F.col("source")), 1, 5), 16, 10).cast("long") / F.lit(float(1 << 20))
    out = ranked.withColumn("copies", copies(F.col("rank"), F.col("target"), F.col("source_size"), offset))
    out = scratch.table(out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "key"), "mixed")
    scratch.drop_all_but("mixed")
    return out


def mixed_documents(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all their columns and the copy's number, from 1.

    The number's column is `copy`, with underscores after it if docs has that name. Rows alike in all columns share their copies.
    """
    scratch, name = Scratch(docs.sparkSession), "copy"
    while name in docs.columns:
        name += "_"
    # A row's key covers all its columns (maps excepted): rows with one key are alike.
    key = F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()])
    whole = docs.select(F.struct("*").alias("row"), key.alias("key"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("key_id"))
    mixed = _mixed(whole.select(F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.source").cast("string").alias("source"), F.col("row.text").alias("text"), "key"), params, F.col("key"))
    keys = ["key_id", "key"]
    drawn = mixed.groupBy(F.coalesce("doc_id", F.lit(-(2**63))).alias("key_id"), "key").agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("alike"))
    drawn = scratch.table(drawn.filter("n > 0"), "drawn")
    hot = hot_keys(drawn, keys, "alike", mixed.count())
    taken = split_join(whole, drawn, keys, "inner", hot, F.monotonically_increasing_id())
    each = lambda lo, hi: F.explode(F.sequence(lo, hi)).alias("copy")
    out = taken.filter("alike = 1").select("row", each(F.lit(1).cast("long"), F.col("n")))
    if drawn.filter("alike > 1").limit(1).count():
        # One of the rows alike stands for all; its copies are dealt out in hundreds.
        one = taken.filter("alike > 1").groupBy(keys).agg(F.first("row").alias("row"), F.first("n").alias("n"))
        hundreds = one.select("row", "n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"), F.lit(100).cast("long"))).alias("lo")).repartition(tasks_of(docs.sparkSession))
        out = out.unionByName(hundreds.select("row", each(F.col("lo"), F.least(F.col("lo") + 99, F.col("n")))))
    return out.select("row.*", F.col("copy").cast("int").alias(name))
