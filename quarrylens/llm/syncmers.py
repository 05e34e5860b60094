"""Fingerprints of whole texts from closed syncmers, with column expressions alone.

A text's symbols are its runs of letters and digits (an ideograph or syllable sign, a mark of punctuation: each its own); its k-mers are its
windows of k symbols, each with k - s + 1 inner substrings of s. A k-mer is an anchor (a closed syncmer) if its first or its last
inner substring has the least hash of them. Whether it is depends on its k symbols alone, never on what stands around
it: a passage that moves keeps its anchors, each shifted alike. A fingerprint has the anchors with the `prints` least codes of the text, each
with its first position, so it is bounded while every window of the text is weighed. A text is weighed in pieces that end where a symbol does
and hand their last symbols on, so memory is that of one piece beside the text.

Likeness is positional matching: of the least codes of both fingerprints, the share that both have at a shift of positions which another
common anchor has too (any shift counts while the two have few codes). It estimates the share of common anchors.

Neighbours by id come from one shuffle of texts: keys (id, digest) are counted and ordered first, and some boundaries for each task cut them
into buckets. A bucket's last text meets its successor because the text at the next boundary is sent to it as well.

Cases: a null text is empty; a text without symbols has no anchors and the empty fingerprint, and two such are alike (1.0); one of fewer than k
symbols is its own only anchor; null ids come first, rows of one id are ordered by their texts' digests; rows alike are each other's
successors, the last of them having the next text; a single row is its own successor; copies of one row are dealt over buckets; texts of any
length; an empty table has no rows. Other columns of the input, clashing names included, are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import Scratch, in_order, let, places, tasks_of


@dataclass(frozen=True)
class SyncmerParams:
    k: int = 5  # symbols of an anchor
    s: int = 2  # symbols of an inner substring
    prints: int = 128  # anchors of a fingerprint
    piece: int = 8192  # code points weighed at once, and what ends their last symbol
    few: int = 16  # codes below which a lone shift counts
    buckets: int = 8  # for each task


_POSITION = (1 << 31) - 1
#: Thai to Tibetan, Burmese, Khmer, kana, ideographs and Korean syllables: signs that are symbols of their own.
_SINGLE = r"\u0E00-\u0FFF\u1000-\u109F\u1780-\u17FF\u3040-\u318F\u31F0-\u31FF\u3400-\u9FFF\uA960-\uA97F\uAA60-\uAA7F\uAC00-\uD7FF\uF900-\uFAFF\x{20000}-\x{3FFFF}"
_RUN = rf"[0-9A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F[\p{{L}}\p{{M}}\p{{N}}&&[^{_SINGLE}]]]"
SYMBOL = rf"{_RUN}{{1,64}}+|\S"


def code(anchor: Column) -> Column:
    return F.shiftright(anchor, 32)


def position(anchor: Column) -> Column:
    return anchor.bitwiseAND(_POSITION)


def _anchor(symbols: list[Column], at: Column) -> Column:
    """31 bits of a hash above 32 bits for the position."""
    return F.shiftleft(F.xxhash64(*symbols).bitwiseAND(_POSITION), 32) + at.cast("bigint")


def _new(anchors: Column) -> Column:
    """Sorted anchors, each code at its first position."""
    return F.filter(anchors, lambda x, i: (i == 0) | (code(x) != code(F.get(anchors, i - 1))))


def least(anchors: Column, p: SyncmerParams) -> Column:
    """The anchors of the least codes, each code at its first position."""
    return F.slice(let(F.sort_array(anchors), _new), 1, p.prints)


def anchors(symbols: Column, base: Column, p: SyncmerParams = SyncmerParams()) -> Column:
    """The anchors among an array of symbols, the first of which is at position base."""
    edge, window = p.k - p.s, lambda of, i, n: [F.get(of, i + j) for j in range(n)]

    def closed(h: Column, i: Column) -> Column:
        low, out = F.least(F.get(h, i), F.get(h, i + edge)), F.lit(True)
        for j in range(1, edge):
            out = out & (low <= F.get(h, i + j))
        return out

    inner = F.transform(symbols, lambda x, i: F.xxhash64(*window(symbols, i, p.s)))
    at = let(inner, lambda h: F.filter(F.sequence(F.lit(0), F.size(symbols) - p.k), lambda i: closed(h, i)))
    found = F.transform(at, lambda i: _anchor(window(symbols, i, p.k), base + i))
    return F.when(F.size(symbols) >= p.k, found).otherwise(none())


def none() -> Column:
    return F.array().cast("array<bigint>")


def start() -> Column:
    """What has been weighed of an empty text: its fingerprint so far, its last k - 1 symbols and the number of its symbols."""
    return F.struct(none().alias("found"), F.array().cast("array<string>").alias("last"), F.lit(0).alias("n"))


def weigh(text: Column, p: SyncmerParams = SyncmerParams(), before: Column | None = None) -> Column:
    """before, with the symbols of text weighed after its own; a symbol must not lie in both."""
    pieces = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{p.piece}}}+{_RUN}*+"), F.lit(0))

    def add(done: Column, piece: Column) -> Column:
        def weighed(symbols: Column) -> Column:
            base = done["n"] - F.size(done["last"])
            last = F.slice(symbols, F.greatest(F.size(symbols) - (p.k - 2), F.lit(1)), F.lit(p.k - 1))
            return F.struct(least(F.concat(done["found"], anchors(symbols, base, p)), p).alias("found"), last.alias("last"), (base + F.size(symbols)).alias("n"))

        return let(F.concat(done["last"], F.regexp_extract_all(piece, F.lit(SYMBOL), F.lit(0))), weighed)

    return F.aggregate(pieces, start() if before is None else before, add)


def finished(weighed: Column, p: SyncmerParams = SyncmerParams()) -> Column:
    few = F.array(F.shiftleft(F.xxhash64(F.array_join(weighed["last"], " ")).bitwiseAND(_POSITION), 32))
    return F.when(weighed["n"] >= p.k, weighed["found"]).when(weighed["n"] > 0, few).otherwise(none())


def fingerprint(text: Column, p: SyncmerParams = SyncmerParams()) -> Column:
    """A text's fingerprint, an array of anchors by code."""
    return let(weigh(F.coalesce(text, F.lit("")), p), lambda w: finished(w, p))


def printed(anchors: Column) -> Column:
    """A fingerprint as text: hexadecimal anchors, comma-joined."""
    return F.array_join(F.transform(anchors, lambda x: F.hex(x)), ",")


def likeness(left: Column, right: Column, p: SyncmerParams = SyncmerParams()) -> Column:
    """How alike two fingerprints are, 0 to 1; 1 if equal."""
    side = lambda a, bit: F.transform(a, lambda x: x + bit)

    def match(a: Column) -> Column:
        # A code that both have stands twice in a, left's first. Only the least codes of both are weighed.
        of = let(_new(a), lambda f: let(F.least(F.size(f), F.lit(p.prints)), lambda n: F.struct(n.alias("n"), code(F.element_at(f, n)).alias("last"))))
        return let(of, lambda weighed: let(shifts(a, weighed["last"]), lambda s: F.size(held(s, weighed["n"])) / weighed["n"]))

    def shifts(a: Column, last: Column) -> Column:
        both = F.filter(F.sequence(F.lit(0), F.size(a) - 2), lambda i: (code(F.get(a, i)) == code(F.get(a, i + 1))) & (code(F.get(a, i)) <= last))
        return F.sort_array(F.transform(both, lambda i: position(F.get(a, i + 1)) - position(F.get(a, i))))

    def held(s: Column, n: Column) -> Column:
        same = lambda x, i: F.coalesce(F.get(s, i) == x, F.lit(False))
        return F.filter(s, lambda x, i: (n < p.few) | same(x, i - 1) | same(x, i + 1))

    some = (F.size(left) > 0) & (F.size(right) > 0)
    return F.when(left == right, 1.0).when(some, let(F.sort_array(F.concat(side(left, F.lit(0)), side(right, F.lit(1 << 31)))), match)).otherwise(0.0)


def common_spans(left: Column, right: Column, p: SyncmerParams = SyncmerParams()) -> Column:
    """Where two texts' fingerprints agree: an array of (shift, start, stop) in the right text, one for each shift of common anchors, the widest first."""
    both = F.filter(F.transform(left, lambda x: F.struct(position(x).alias("l"), F.filter(right, lambda y: code(y) == code(x))[0].alias("r"))), lambda m: m["r"].isNotNull())
    moved = F.transform(both, lambda m: F.struct((position(m["r"]) - m["l"]).alias("shift"), position(m["r"]).alias("at")))

    def spans(ms: Column) -> Column:
        at = lambda d: F.transform(F.filter(ms, lambda m: m["shift"] == d), lambda m: m["at"])
        of = F.transform(F.array_distinct(F.transform(ms, lambda m: m["shift"])), lambda d: F.struct(d.alias("shift"), F.array_min(at(d)).alias("start"), (F.array_max(at(d)) + p.k).alias("stop")))
        return F.array_sort(of, lambda a, b: ((b["stop"] - b["start"]) - (a["stop"] - a["start"])).cast("int"))

    return let(moved, spans)


def _key(doc_id: Column, text: Column) -> Column:
    """A text that sorts as (null ids, id, digest of the text) does."""
    number = F.lpad(F.hex(doc_id.cast("bigint").bitwiseXOR(F.lit(-(2**63)))), 16, "0")
    return F.concat(F.coalesce(F.concat(F.lit("1"), number), F.lit("0")), F.md5(text))


def _bucket(key: Column, bounds: list[str]) -> Column:
    """The number of the last bound that isn't after key: bisection, so a key costs the logarithm of the bounds."""
    table, steps = F.lit(bounds), [1 << j for j in reversed(range(len(bounds).bit_length()))]
    fits = lambda at: (at < len(bounds)) & (F.get(table, at) <= key)
    return F.aggregate(F.lit(steps), F.lit(0), lambda at, step: F.when(fits(at + step), at + step).otherwise(at))


def with_successor(docs: DataFrame, scratch: Scratch, p: SyncmerParams = SyncmerParams()) -> DataFrame | None:
    """(doc_id, text, bucket, part, key, sent): rows by bucket and part in order of key, each bucket's successor last, marked as sent. None without rows.

    A key that more rows share than a bucket should hold has a bucket of its own, in parts, each but the last followed by that row once more.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), _key(F.col("doc_id"), text).alias("key"))
    keys = in_order(scratch, rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")), [F.asc("key")], "keys")
    total = keys.agg(F.sum("n")).first()[0]
    if not total:
        return None
    fair = -(-total // (p.buckets * tasks_of(spark)))
    most = max(64, fair)
    ordered = places(keys)
    # Fewer rows than 3 x buckets x tasks: every fair-th key, keys with more rows than a bucket should have, and the keys after those.
    after = ordered.filter(F.col("n") > most).select((F.col("place") + 1).alias("place"))
    cut = ordered.filter((F.col("place") % fair == 0) | (F.col("n") > most)).select("key", "n").unionByName(ordered.join(F.broadcast(after), "place").select("key", "n"))
    bounds = sorted({(r.key, r.n) for r in cut.collect()})
    names, parts = [k for k, _ in bounds], [-(-n // most) if n > most else 1 for _, n in bounds]
    sends = [(b, part, names[b] if part < parts[b] - 1 else names[(b + 1) % len(names)]) for b in range(len(names)) for part in range(parts[b])]
    sends = F.broadcast(spark.createDataFrame(sends, "bucket int, part int, key string"))
    at_bound = rows.join(F.broadcast(spark.createDataFrame([(k,) for k in names], "key string")), "key").groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    sent = at_bound.join(sends, "key").select("doc_id", "text", "bucket", "part", F.lit(None).cast("string").alias("key"), F.lit(True).alias("sent"))
    own = rows.withColumn("bucket", _bucket(F.col("key"), names)).withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.get(F.lit(parts), F.col("bucket"))).cast("int"))
    return own.withColumn("sent", F.lit(False)).select("doc_id", "text", "bucket", "part", "key", "sent").unionByName(sent)


def fingerprints(docs: DataFrame, p: SyncmerParams = SyncmerParams()) -> DataFrame:
    """Each text's fingerprint, that of its edited text (its last quarter replaced by the next text's beginning) and the next text's.

    (doc_id, n_chars, text, edited, print, edited_print, next_print).
    """
    scratch = Scratch(docs.sparkSession)
    dealt = with_successor(docs, scratch, p)
    if dealt is None:
        empty = docs.limit(0).select("doc_id", F.lit(0).cast("bigint").alias("n_chars"), F.lit("").alias("text"), F.lit("").alias("edited"))
        return empty.select("*", *[none().alias(x) for x in ("print", "edited_print", "next_print")])
    order = Window.partitionBy("bucket", "part").orderBy("sent", "key")
    rows = dealt.withColumn("n", F.char_length("text")).withColumn("q", F.floor(F.col("n") / 4).cast("int")).withColumn("want", F.coalesce(F.lag("q").over(order), F.lit(0)))
    # What is kept, up to its last white space, is weighed once for the text and the edited text.
    kept, head = F.substring("text", F.lit(1), F.col("n") - F.col("q")), F.regexp_extract("kept", r"(?s)^.*\s", 0)
    rows = rows.withColumn("kept", kept).withColumn("head", F.char_length(head)).withColumn("weighed", weigh(F.substring("text", F.lit(1), F.col("head")), p))
    after = lambda rest: let(weigh(rest, p, F.col("weighed")), lambda w: finished(w, p))
    rows = rows.withColumn("print", after(F.substring("text", F.col("head") + 1, F.col("n")))).withColumn("put", F.substring("text", F.lit(1), F.col("want")))
    rows = rows.withColumn("next", F.lead(F.struct("put", "print")).over(order)).filter(~F.col("sent"))
    rows = rows.withColumn("edited_print", after(F.concat(F.substring("kept", F.col("head") + 1, F.col("n")), F.col("next.put"))))
    return rows.select("doc_id", F.col("n").cast("bigint").alias("n_chars"), "text", F.concat("kept", "next.put").alias("edited"), "print", "edited_print", F.col("next.print").alias("next_print"))


def fingerprint_report(docs: DataFrame, p: SyncmerParams = SyncmerParams()) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    found = fingerprints(docs, p)
    likely = lambda other: likeness(F.col("print"), F.col(other), p)
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), printed(F.col("print")).alias("fingerprint"), printed(F.col("edited_print")).alias("edited_fingerprint"), likely("edited_print").alias("near_edited"), likely("next_print").alias("near_next"))
