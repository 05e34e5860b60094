"""Near-duplicate classes by BagMinHash.

A document's features are its five-word shingles with their counts (lower-cased words of ASCII letters, digits and
non-ASCII characters). The signature is made by hierarchical Poisson processes: the weights are cut into the levels
(0,1], (1,2], (2,4], (4,8] ...; each level of each shingle is one Poisson process whose points carry a signature
component and, by successive fair halvings, a unit of the level. A point counts if its unit lies within the weight, so
two documents share exactly the points below the smaller of their weights and the chance that a component agrees is the
weighted Jaccard similarity. Points come in ascending order and a process ends once it has passed the largest value of
its document's signature, so the work is about m log m + n points and grows with the logarithm of a weight.

Bands of the signature give buckets. Texts of one bucket are not paired with each other: all are held against the
bucket's most central text, the similarity is computed on the exact multisets, and the classes are the connected
components. What shares a bucket with the centre and isn't yet in its class is then held against the other classes of
the bucket inside the join's condition, so that only true links leave the join and none is lost. One minus the similarity is a
metric, so two texts whose similarities to the centre differ by more than one minus the threshold can't be linked, nor can two
whose masks of 1,024 bits differ in more bits than their multisets may in shingles: only what is left is compared exactly. These comparisons go in blocks of `block` by `block` texts.

Exact copies are one row (a text's print) before anything is joined. A bucket, centre, print or class that holds many rows
is cut into slices (`split_join`), so no key has to fit in a task.

Cases: a null text or one without a word is a class of its own. A text of one to four words has one shingle. Equal word
sequences are always one class. Repeated rows, also with the same id, are one class. An empty table gives no rows. A class is
its component, whatever the ids: null ids, or one id of several different texts, join nothing. Its reported name is the least
doc_id; where that is null or also names another class it is a negative number made of the component's least print. Texts
without a word always report their doc_id, null if they have none.
Other columns of the input are ignored by `near_duplicate_classes` and kept by `keep_one_per_class`.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import LOWER, SHINGLE, WORD_BYTE, Scratch, Words, hot_in, hot_keys, mix64, row_chunks, small_batches, split_join, utf8_parts


@dataclass(frozen=True)
class NearDupParams:
    """bands of band_rows components: a pair at the threshold meets in a band with probability 1 - (1 - 0.8**5)**25 = 0.99995."""

    threshold: float = 0.8
    bands: int = 25
    band_rows: int = 5
    shingle: int = SHINGLE
    block: int = 2000

    @property
    def m(self) -> int:
        return self.bands * self.band_rows


_GOLD, _LEVEL = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xA24BAED4963EE407)


def _times(x: np.uint64, k: int) -> np.uint64:
    return np.uint64(int(x) * k & 0xFFFFFFFFFFFFFFFF)


def bag_signature(row: np.ndarray, element: np.ndarray, weight: np.ndarray, rows: int, m: int) -> np.ndarray:
    """rows x m signature values. row, element (64-bit), weight (at least 1): one entry for each distinct element of a row."""
    h = np.full(rows * m, np.inf)
    parts, level, top = [], 0, int(weight.max(initial=0))
    while level == 0 or 1 << (level - 1) < top:
        has = np.flatnonzero(weight > (1 << (level - 1) if level else 0))
        parts.append((row[has], mix64(element[has] + _times(_LEVEL, level)), np.full(len(has), float(1 << max(level - 1, 0)) * m), weight[has], np.full(len(has), level)))
        level += 1
    owner, seed, rate, weight, level = (np.concatenate(x) for x in zip(*parts, strict=True))
    x, step = np.zeros(len(owner)), 0
    while len(owner):
        # Points of each process, more at once as fewer processes are left; one beyond the end lowers no component.
        k = int(min(64, max(1, 100_000 // len(owner))))
        number = np.array([int(_GOLD) * (step + i) & 0xFFFFFFFFFFFFFFFF for i in range(1, k + 1)], dtype=np.uint64)
        step += k
        u = mix64(seed[:, None] + number[None, :])
        # Added one after the other from the running x: a text's values are the same to the bit whatever else is in the batch.
        steps = -np.log1p(-((u >> np.uint64(12)).astype(np.float64) * 2.0**-52)) / rate[:, None]
        steps[:, 0] += x
        x = np.cumsum(steps, axis=1)
        v = mix64(u ^ _LEVEL)
        at = owner[:, None] * m + ((v & np.uint64(0xFFFFFFFF)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        value = x
        deep = np.flatnonzero(level > 0)
        if len(deep):
            width = (level[deep] - 1).astype(np.uint64)[:, None]
            unit = (np.uint64(1) << width) + np.uint64(1) + ((v[deep] >> np.uint64(32)) & ((np.uint64(1) << width) - np.uint64(1)))
            value = x.copy()
            value[deep] = np.where(unit > weight[deep].astype(np.uint64)[:, None], np.inf, x[deep])
        below = np.flatnonzero((value < h[at]).ravel())
        np.minimum.at(h, at.ravel()[below], value.ravel()[below])
        x = x[:, -1]
        go = x < h.reshape(rows, m).max(axis=1)[owner]
        owner, seed, rate, weight, level, x = owner[go], seed[go], rate[go], weight[go], level[go], x[go]
    return h.reshape(rows, m)


def counted(row: np.ndarray, code: np.ndarray, bits: int = 44) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, element and weight of the distinct shingles. Only signatures use it: an element keeps `bits` bits of its hash."""
    key = np.sort((row.astype(np.uint64) << np.uint64(bits)) | (code >> np.uint64(64 - bits)))
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return (key[new] >> np.uint64(bits)).astype(np.int64), key[new] & np.uint64((1 << bits) - 1), np.diff(np.append(new, len(key)))


def _prints(words: Words, data: np.ndarray) -> list[bytes | None]:
    """128 bits of each row's word sequence."""
    lower = (LOWER - np.uint64(1)).astype(np.uint8)[data]
    keep = np.zeros(len(data) + 1, dtype=np.int32)
    keep[words.start] += 1
    keep[words.end] -= 1
    inside = np.cumsum(keep[:-1]) > 0
    gap = words.end[words.end < len(data)]
    gap = gap[~WORD_BYTE[data[gap]]]  # one separator after each word; a word byte there begins the next row
    inside[gap], lower[gap] = True, 0x20
    first = np.concatenate(([0], np.cumsum(words.count)))
    out: list[bytes | None] = []
    for r in range(words.rows):
        if not words.count[r]:
            out.append(None)
            continue
        lo, hi = words.start[first[r]], words.end[first[r + 1] - 1]
        out.append(blake2b(lower[lo:hi][inside[lo:hi]].tobytes(), digest_size=16).digest())
    return out


def _signer(p: NearDupParams):
    names = ["doc_id", "tkey", "fp", "n", "bands"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int64())]

    def run(batches):
        for batch in batches:
            data, off = utf8_parts(batch.column(2))
            for lo, hi in row_chunks(off):
                part = data[off[lo] : off[hi]]
                words = Words(part, off[lo : hi + 1] - off[lo])
                row, code, _ = words.shingles(p.shingle)
                n = np.bincount(row, minlength=hi - lo)
                h = bag_signature(*counted(row, code), hi - lo, p.m).view(np.uint64).reshape(hi - lo, p.bands, p.band_rows)
                key = np.zeros((hi - lo, p.bands), dtype=np.uint64) + np.arange(p.bands, dtype=np.uint64)
                for k in range(p.band_rows):
                    key = mix64(key * _GOLD + h[:, :, k])
                prints = _prints(words, part)
                flat = pa.array(key.view(np.int64).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (hi - lo + 1) * p.bands, p.bands, dtype=np.int32)), flat)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array([x and x.hex() for x in prints], pa.string()), pa.array(n), lists], schema=pa.schema(list(zip(names, kinds, strict=True))))

    return run


MASK = 16  # 64-bit words of a mask


def masks(row: np.ndarray, code: np.ndarray, rows: int) -> pa.ListArray:
    """For each row MASK words of 64 bits: a bit says whether an odd number of the row's codes falls on it."""
    bit = (row.astype(np.int64) * MASK * 64) + (code % np.uint64(MASK * 64)).astype(np.int64)
    odd = (np.bincount(bit, minlength=rows * MASK * 64) & 1).astype(np.uint8)
    words = np.packbits(odd, bitorder="little").view("<i8")
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (rows + 1) * MASK, MASK, dtype=np.int32)), pa.array(words))


def _shingler(p: NearDupParams):
    """The exact multiset of each text: sorted 64-bit codes, the k-th repeat of a shingle coded apart from the first; and its mask."""

    def run(batches):
        for batch in batches:
            data, off = utf8_parts(batch.column(0))
            for lo, hi in row_chunks(off):
                part = data[off[lo] : off[hi]]
                words = Words(part, off[lo : hi + 1] - off[lo])
                row, code, _ = words.shingles(p.shingle)
                order = np.lexsort((code, row))
                row, code = row[order], code[order]
                run_start = np.concatenate(([True], (row[1:] != row[:-1]) | (code[1:] != code[:-1]))) if len(row) else np.zeros(0, bool)
                first = np.flatnonzero(run_start)
                again = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
                code = np.where(again > 0, mix64(code + again.astype(np.uint64) * _GOLD), code)
                ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=hi - lo)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([x and x.hex() for x in _prints(words, part)], pa.string()), pa.ListArray.from_arrays(pa.array(ends), pa.array(code.view(np.int64))), masks(row, code, hi - lo)], names=["fp", "bag", "mask"])

    return run


def similarity(a, b):
    """Weighted Jaccard of two multisets coded as sets."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def may_reach(a: list, b: list, n_a, n_b, threshold: float):
    """Whether multisets of n_a and n_b codes with masks a and b can be alike to the threshold.

    A code that only one of them has turns one bit of its mask, so masks differ in at most as many bits as the multisets
    differ in codes: what this leaves out is below the threshold.
    """
    apart = F.bit_count(a[0].bitwiseXOR(b[0]))
    for x, y in zip(a[1:], b[1:], strict=True):
        apart = apart + F.bit_count(x.bitwiseXOR(y))
    return apart <= (n_a + n_b) * F.lit((1 - threshold) / (1 + threshold)) + 1e-6


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, label): the least node of each connected component of edges (a, b), for nodes that have an edge.

    Each round takes the least label among the neighbours and then the label of the label; it ends when nothing changes.
    """
    both = scratch.table(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    label = scratch.table(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), f"{name}-0")
    hubs, turn = hot_in(both, ["b"]), 0
    while True:
        turn += 1
        near = split_join(both, label.select(F.col("node").alias("b"), "label"), ["b"], "inner", hubs, F.col("a")).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = label.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        lower = scratch.table(lower, f"{name}-{turn}-low")
        up = lower.select(F.col("node").alias("label"), F.col("label").alias("upper"))
        new = split_join(lower, up, ["label"], "left", hot_in(lower, ["label"]), F.col("node")).select("node", "was", F.least("label", F.coalesce("upper", "label")).alias("label"))
        new = scratch.table(new, f"{name}-{turn}")
        changed = new.filter("label <> was").limit(1).count()
        scratch.drop(f"{name}-{turn}-low", f"{name}-{turn - 1}")
        label = new.select("node", "label")
        if not changed:
            scratch.drop(f"{name}-edges")
            return label


def _classes(docs: DataFrame, scratch: Scratch, p: NearDupParams) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three written tables: signed (doc_id, tkey, fp, n, bands) for each row of docs; distinct (fp, n, bands, copies, least) for
    each text's print; linked (fp, label) for the prints that are linked to others.

    tkey is a 64-bit key of the text as it stands, fp 128 bits of its word sequence in hexadecimal, null without a word.
    """
    small_batches(docs.sparkSession)
    texts = _keyed(docs.select("doc_id", "text")).select("doc_id", "tkey", F.col("text").cast("string").alias("text"))
    signed = scratch.table(texts.mapInArrow(_signer(p), "doc_id long, tkey long, fp string, n long, bands array<long>"), "signed")

    one = F.min(F.struct(_id("doc_id").alias("key_id"), "tkey")).alias("one")
    distinct = scratch.table(signed.filter("fp is not null").groupBy("fp").agg(F.first("n").alias("n"), F.first("bands").alias("bands"), F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least"), one), "distinct")
    banded = distinct.select("fp", "n", F.explode("bands").alias("bucket"))
    buckets = scratch.table(banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"), "buckets")
    hot = hot_keys(buckets, ["bucket"], "members", distinct.count() * p.bands)
    shared = scratch.table(split_join(banded, buckets, ["bucket"], "inner", hot, F.col("fp")), "shared")
    central = shared.groupBy("fp").agg(F.sum("members").alias("central"))
    ranked = scratch.table(shared.drop("members").join(central, "fp"), "ranked")
    scratch.drop("shared")
    pivots = ranked.groupBy("bucket").agg(F.max(F.struct("central", "fp")).alias("top")).select("bucket", F.col("top.fp").alias("pivot"))
    pivots = scratch.table(pivots, "pivots")
    edges = split_join(ranked, pivots, ["bucket"], "inner", hot, F.col("fp")).filter(F.col("fp") != F.col("pivot")).select("fp", "pivot").distinct()
    edges = scratch.table(edges, "edges")

    # One row of each text in a shared bucket is read again for its exact multiset.
    ones = distinct.join(ranked.select("fp"), "fp", "left_semi").select("one.*")
    again = texts.withColumn("key_id", _id("doc_id"))
    repeats = signed.filter("fp is not null").select(_id("doc_id").alias("key_id"), "tkey")
    again = split_join(again, ones, ["key_id", "tkey"], "left_semi", hot_in(repeats, ["key_id", "tkey"]), F.monotonically_increasing_id())
    bags = scratch.table(again.select("text").mapInArrow(_shingler(p), "fp string, bag array<long>, mask array<long>").dropDuplicates(["fp"]), "bags")

    ends = split_join(edges.join(bags.drop("mask"), "fp"), bags.select(F.col("fp").alias("pivot"), F.col("bag").alias("pivot_bag")), ["pivot"], "inner", hot_in(edges, ["pivot"]), F.col("fp"))
    near = scratch.table(ends.select("fp", "pivot", similarity(F.col("bag"), F.col("pivot_bag")).alias("s")), "near")
    scratch.drop("edges")
    first = components(near.filter(F.col("s") >= p.threshold).select(F.col("fp").alias("a"), F.col("pivot").alias("b")), scratch, "first")

    # What the centre doesn't link: held against every other class of its bucket, the similarity being part of the join.
    tops = pivots.join(first.select(F.col("node").alias("pivot"), F.col("label").alias("top")), "pivot", "left").select("bucket", "pivot", F.coalesce("top", "pivot").alias("top"))
    classed = ranked.join(first.select(F.col("node").alias("fp"), "label"), "fp", "left").select("bucket", "fp", "n", F.coalesce("label", "fp").alias("label"))
    opened = split_join(classed, tops, ["bucket"], "inner", hot, F.col("fp")).filter("fp <> pivot").join(near, ["fp", "pivot"])
    opened = scratch.table(opened.select("bucket", "fp", "n", "label", "top", "s"), "opened")
    scratch.drop("ranked", "near")
    odd = opened.groupBy("bucket").agg(F.count_if(F.col("label") != F.col("top")).alias("odd"), F.count(F.lit(1)).alias("all")).filter("odd > 0")
    odd = scratch.table(odd.select("bucket", F.ceil(F.col("odd") / p.block).cast("int").alias("down"), F.ceil(F.col("all") / p.block).cast("int").alias("across")), "odd")
    linked = first
    if odd.limit(1).count():
        rest = split_join(opened, odd, ["bucket"], "inner", hot, F.col("fp"))
        rest = scratch.table(rest, "rest")
        block = lambda n: F.pmod(F.xxhash64("fp"), F.col(n))
        each = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n).cast("bigint") - 1))
        mask = lambda side: [F.col("mask")[k].alias(f"{side}_mask{k}") for k in range(MASK)]
        y = rest.filter("label <> top").join(bags, "fp").select("bucket", block("down").alias("i"), each("across").alias("j"), *[F.col(c).alias(f"a_{c}") for c in ("fp", "n", "label", "s", "bag")], *mask("a"))
        x = rest.join(bags, "fp").select("bucket", each("down").alias("i"), block("across").alias("j"), *[F.col(c).alias(f"b_{c}") for c in ("fp", "n", "label", "top", "s", "bag")], *mask("b"))
        # In this order: what costs least and leaves out most comes first.
        fit = F.abs(F.col("a_s") - F.col("b_s")) <= 1 - p.threshold + 1e-9
        fit &= F.least("a_n", "b_n") >= F.lit(p.threshold) * F.greatest("a_n", "b_n")
        fit &= may_reach(*[[F.col(f"{side}_mask{k}") for k in range(MASK)] for side in "ab"], F.col("a_n"), F.col("b_n"), p.threshold)
        fit &= (F.col("a_label") != F.col("b_label")) & ((F.col("b_label") == F.col("b_top")) | (F.col("a_fp") < F.col("b_fp")))
        fit &= similarity(F.col("a_bag"), F.col("b_bag")) >= p.threshold
        more = y.join(x, (y["bucket"] == x["bucket"]) & (y["i"] == x["i"]) & (y["j"] == x["j"]) & fit)
        more = scratch.table(more.select(F.col("a_label").alias("a"), F.col("b_label").alias("b")).distinct(), "more")
        # Classes are joined by their labels; a text that was alone is its own label.
        joined = components(more, scratch, "joined")
        alone = joined.join(first.select("node"), "node", "left_anti").select("node", F.col("node").alias("label"))
        whole = scratch.table(first.unionByName(alone), "whole")
        upper = joined.select(F.col("node").alias("label"), F.col("label").alias("upper"))
        linked = split_join(whole, upper, ["label"], "left", hot_in(whole, ["label"]), F.col("node")).select("node", F.coalesce("upper", "label").alias("label"))
    linked = scratch.table(linked.select(F.col("node").alias("fp"), "label"), "linked")
    scratch.drop_all_but("signed", "distinct", "linked")
    return signed, distinct, linked


def near_duplicate_classes(docs: DataFrame, params: NearDupParams = NearDupParams()) -> DataFrame:
    """(doc_id, tkey, fp, n_shingles, class_id), a row for each row of docs.

    Rows of one class share class_id, the name of the class. tkey and fp as in `_classes`.
    """
    scratch = Scratch(docs.sparkSession)
    signed, distinct, linked = _classes(docs, scratch, params)
    labelled = scratch.table(distinct.select("fp", "least", "copies").join(linked, "fp", "left").select("fp", "least", "copies", F.coalesce("label", "fp").alias("label")), "labelled")
    ids = scratch.table(labelled.groupBy("label").agg(F.min("least").alias("name")), "names")
    wordless = signed.filter("fp is null").select(F.col("doc_id").alias("name")).distinct()
    shared = ids.select("name").unionByName(wordless).filter("name is not null").groupBy("name").agg(F.count(F.lit(1)).alias("classes")).filter("classes > 1")
    made = F.lit(-1) - F.xxhash64("label").bitwiseAND(F.lit(2**63 - 1))
    # A class without a name joins by a number of its own, so that such classes don't meet in one task.
    ids = ids.withColumn("key", F.coalesce("name", made)).join(shared.select(F.col("name").alias("key"), F.lit(True).alias("shared")), "key", "left")
    ids = ids.select("label", F.when(F.col("name").isNull() | F.col("shared"), made).otherwise(F.col("name")).alias("class_id"))
    ids = scratch.table(split_join(labelled, ids, ["label"], "inner", hot_in(labelled, ["label"]), F.col("fp")).select("fp", "copies", "class_id"), "ids")
    hot = hot_keys(ids, ["fp"], "copies", signed.count())
    # Texts without a word join by a key of their own, so that they don't meet in one task.
    keyed = signed.select("doc_id", "tkey", F.coalesce("fp", F.concat(F.lit("-"), F.monotonically_increasing_id())).alias("fp"), "n")
    out = split_join(keyed, ids.select("fp", "class_id"), ["fp"], "left", hot, F.monotonically_increasing_id())
    none = F.col("fp").startswith("-")
    out = out.select("doc_id", "tkey", F.when(~none, F.col("fp")).alias("fp"), F.col("n").alias("n_shingles"), F.when(none, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))
    out = scratch.table(out, "out")
    scratch.drop_all_but("out")
    return out


def _id(name: str):
    """A null id as a key that joins."""
    return F.coalesce(F.col(name), F.lit(-(2**63)))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("tkey"), "text")


def keep_one_per_class(docs: DataFrame, params: NearDupParams = NearDupParams()) -> DataFrame:
    """The rows of docs without all but one row of each class: the least doc_id stays (a null one last), of its repeated rows any one.

    Rows without a word all stay. All columns of docs are kept, whatever their names.
    """
    scratch = Scratch(docs.sparkSession)
    signed, distinct, linked = _classes(docs, scratch, params)
    linked = distinct.select("fp", "copies").join(linked, "fp", "left").select("fp", "copies", F.unhex(F.coalesce("label", "fp")).alias("label"))
    linked = scratch.table(linked, "labels")
    hot = hot_keys(linked, ["fp"], "copies", signed.count())
    signed = signed.filter("fp is not null").select("doc_id", "tkey", "fp")
    labelled = split_join(signed, linked.drop("copies"), ["fp"], "inner", hot, F.monotonically_increasing_id())
    rows = labelled.groupBy(_id("doc_id").alias("key_id"), "tkey").agg(F.min("label").alias("label"), F.count(F.lit(1)).alias("copies"), F.first(F.col("doc_id").isNull()).alias("no_id"))
    rows = scratch.table(rows, "rows")
    best = rows.groupBy("label").agg(F.min(F.struct("no_id", "key_id", "tkey")).alias("stays"))
    best = best.select(F.col("stays.key_id").alias("key_id"), F.col("stays.tkey").alias("tkey"), F.lit(True).alias("stays"))
    judged = scratch.table(rows.join(best, ["key_id", "tkey"], "left").select("key_id", "tkey", "copies", F.coalesce("stays", F.lit(False)).alias("stays")).filter("not stays or copies > 1"), "judged")
    scratch.drop_all_but("judged")
    keys = ["key_id", "tkey"]
    hot = hot_keys(judged, keys, "copies", judged.agg(F.sum("copies")).first()[0] or 0)
    whole = docs.select(F.struct("*").alias("row"), _id("doc_id").cast("long").alias("key_id"), F.xxhash64(F.col("text").cast("string")).alias("tkey"))
    out = split_join(whole, judged.select(keys), keys, "left_anti", hot, F.monotonically_increasing_id())
    repeated = judged.filter("stays and copies > 1").select(keys)
    if repeated.limit(1).count():
        # Of rows alike in id and text the one with the least hash of its other columns stays.
        plain = [F.col("row")[f.name] for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
        once = split_join(whole, repeated, keys, "inner", hot, F.monotonically_increasing_id()).groupBy(keys).agg(F.min_by("row", F.xxhash64(*plain)).alias("row"))
        out = out.select("row").unionByName(once.select("row"))
    return out.select("row.*")
