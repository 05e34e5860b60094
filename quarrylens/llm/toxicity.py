"""Toxicity scores by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct n-grams of four to six characters of the lower-cased text, runs of other characters than
ASCII letters and digits and those from U+00C0 on being one space, with one space before and after each text, so that a
score depends on its text alone. From a bounded sample of labelled rows come, for each n-gram, the numbers of toxic
and of other texts that hold it; its value is the log ratio of the two smoothed shares. The n-grams that tell most are
the vocabulary (exact 64-bit codes, not buckets), and a logistic regression with an L2 penalty is fitted on presence
times ratio. The sample takes toxic and other rows by their own bounds; weights restore the shares of all labelled rows.

Cases: null and empty texts have no n-gram and get the score of the intercept. A document is toxic if any of its labels
is 1; null labels and labels without a document don't count, neither for the shares nor for the sample. Of several rows
with a sampled id the fit takes the shortest text. Without a training row, or with one class only, every score is the share of
toxic rows (0 without any). A null doc_id is held out. Repeated rows get one score each. The fit doesn't depend on the order
of rows. Other columns of the inputs are ignored. Very long texts are scored whole; a text that is longer than what is left
of `most_bytes` isn't in the sample.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import Scratch, mix64, row_chunks, small_batches, utf8_parts


_FIT_BYTES = 1_000_000


@dataclass(frozen=True)
class ToxicityParams:
    orders: tuple[int, ...] = (4, 5, 6)
    most_toxic: int = 2000  # labelled rows of each class that the fit may use
    most_other: int = 4000
    most_bytes: int = 64_000_000  # of the sampled texts together
    vocabulary: int = 6_000
    least_texts: int = 4  # of the sample that hold an n-gram of the vocabulary
    smoothing: float = 1.0
    penalty: float = 2.0
    steps: int = 150


_BASE, _SLOTS = np.uint64(0x5851F42D4C957F2D), 22
_SPREAD = mix64(np.arange(1, 33, dtype=np.uint64)) | np.uint64(1)


def _characters(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points of some texts and the row of each; every text has a space of its own at either end."""
    texts = [f" {bytes(data[a:b]).decode('utf-8', 'replace').lower()} " for a, b in zip(off[:-1], off[1:], strict=True)]
    code = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    blank = ~(((code >= 97) & (code <= 122)) | ((code >= 48) & (code <= 57)) | (code >= 0xC0))
    keep = np.ones(len(code), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1] & (row[1:] == row[:-1]))
    code[blank] = 32
    return code[keep], row[keep]


def ngrams(data: np.ndarray, off: np.ndarray, orders: tuple[int, ...]):
    """For each order the row of each character and the rolling hash of the n-gram that begins there, and the order."""
    code, row = _characters(data, off)
    h = code
    for n in range(2, max(orders) + 1):
        if len(code) < n:
            return
        h = h[:-1] * _BASE + code[n - 1 :]
        if n in orders:
            yield row, h, n


def _slot(h: np.ndarray, n: int) -> np.ndarray:
    return (h * _SPREAD[n]) >> np.uint64(64 - _SLOTS)


def _within(row: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Those of some n-grams that lie in one text, its own two spaces included."""
    return at[row[at] == row[at + n - 1]]


def _distinct(key: np.ndarray) -> np.ndarray:
    key = np.sort(key)
    return key[np.concatenate(([True], key[1:] != key[:-1]))] if len(key) else key


def _pairs(row: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of a row and a number below 2**32."""
    key = _distinct((row.astype(np.uint64) << np.uint64(32)) | number.astype(np.uint64))
    return (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)


class ToxicityModel:
    """A sorted vocabulary of codes with a weight each, and an intercept."""

    def __init__(self, orders: tuple[int, ...], codes: np.ndarray, slots: np.ndarray, weights: np.ndarray, intercept: float):
        self.orders, self.codes, self.slots, self.weights, self.intercept = orders, codes, slots, weights, intercept
        self._seen = None

    def __getstate__(self):
        return self.__dict__ | {"_seen": None}

    def features(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and vocabulary number of the distinct features of each text."""
        if self._seen is None:
            self._seen = np.zeros(1 << _SLOTS, dtype=bool)
            self._seen[self.slots] = True
        rows, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for row, h, n in ngrams(data, off, self.orders):
            maybe = _within(row, np.flatnonzero(self._seen[_slot(h, n)]), n)
            code = mix64(h[maybe] + np.uint64(n))
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            hit = self.codes[at] == code
            rows.append(row[maybe[hit]])
            numbers.append(at[hit])
        return _pairs(np.concatenate(rows), np.concatenate(numbers))

    def scores(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        out = np.full(len(off) - 1, self.intercept)
        if len(self.codes):
            for lo, hi in row_chunks(off):
                row, number = self.features(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
                out[lo:hi] += np.bincount(row, self.weights[number], minlength=hi - lo)
        return 1 / (1 + np.exp(-np.clip(out, -700, 700)))


def _constant(orders, share: float) -> ToxicityModel:
    share = min(max(share, 1e-9), 1 - 1e-9) if share else 0
    return ToxicityModel(orders, np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0), np.log(share / (1 - share)) if share else -700.0)


def fit(texts: pa.Array, toxic: np.ndarray, share: float, p: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    """share: of toxic rows among all labelled ones."""
    if not len(toxic) or not 0 < toxic.mean() < 1:
        return _constant(p.orders, share)
    data, off = utf8_parts(texts)
    size = np.array([max((~toxic).sum(), 1), max(toxic.sum(), 1)], dtype=float)

    # First by slots of a table, then exactly for the n-grams of the slots that tell most.
    count = np.zeros((2, 1 << _SLOTS), dtype=np.int32)
    for lo, hi in row_chunks(off, _FIT_BYTES):
        for row, h, n in ngrams(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], p.orders):
            at = _within(row, np.arange(len(h)), n)
            r, slot = _pairs(row[at], _slot(h[at], n))
            for c in (0, 1):
                count[c] += np.bincount(slot[toxic[lo + r] == c], minlength=1 << _SLOTS).astype(np.int32)

    def tells(n0, n1):
        """Log ratio of the smoothed shares, and how many standard errors it is from 0."""
        r = np.log((n1 + p.smoothing) / (size[1] + 2 * p.smoothing)) - np.log((n0 + p.smoothing) / (size[0] + 2 * p.smoothing))
        return r, np.abs(r) / np.sqrt(1 / (n1 + p.smoothing) + 1 / (n0 + p.smoothing))

    z = np.where(count.sum(axis=0) >= p.least_texts, tells(*count)[1], 0)
    slots = np.zeros(1 << _SLOTS, dtype=bool)
    slots[np.argpartition(-z, 2 * p.vocabulary)[: 2 * p.vocabulary]] = True
    slots &= z > 0
    seen: list[np.ndarray] = []
    for lo, hi in row_chunks(off, _FIT_BYTES):
        for row, h, n in ngrams(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], p.orders):
            slot = _slot(h, n)
            at = _within(row, np.flatnonzero(slots[slot]), n)
            r, code, slot = row[at], mix64(h[at] + np.uint64(n)), slot[at]
            order = np.lexsort((code, r))
            r, code, slot = r[order], code[order], slot[order]
            new = np.concatenate(([True], (r[1:] != r[:-1]) | (code[1:] != code[:-1]))) if len(r) else np.zeros(0, bool)
            seen.append(np.stack((code[new], toxic[lo + r[new]].astype(np.uint64), slot[new])))
    codes, kind, slot = np.concatenate(seen, axis=1)
    codes, one, back = np.unique(codes, return_index=True, return_inverse=True)
    slot = slot[one]
    n1 = np.bincount(back, kind.astype(float), minlength=len(codes))
    n0 = np.bincount(back, minlength=len(codes)) - n1
    ratio, z = tells(n0, n1)
    z[n0 + n1 < p.least_texts] = 0
    best = np.sort(np.argsort(-z, kind="stable")[: p.vocabulary])
    best = best[z[best] > 0]
    model = ToxicityModel(p.orders, codes[best], slot[best], np.zeros(len(best)), 0.0)
    ratio = ratio[best]

    rows, numbers = [], []
    for lo, hi in row_chunks(off, _FIT_BYTES):
        row, number = model.features(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
        rows.append(row + lo)
        numbers.append(number)
    row, number = np.concatenate(rows), np.concatenate(numbers)
    y = toxic.astype(float)
    weight = np.where(toxic, share / size[1], (1 - share) / size[0]) * len(y)
    value = ratio[number]
    w, b = np.zeros(len(best)), np.log(share / (1 - share))
    # Nesterov's method, the step by the curvature's bound along the features' scale.
    spread = np.bincount(row, value**2, minlength=len(y))
    step = 1 / (0.25 * (weight * (spread + 1)).sum() / len(y) * 4 + p.penalty / len(y))
    vw, vb, lw, lb, t = w.copy(), b, w.copy(), b, 1.0
    for _ in range(p.steps):
        margin = np.bincount(row, value * vw[number], minlength=len(y)) + vb
        off_by = weight * (1 / (1 + np.exp(-np.clip(margin, -700, 700))) - y) / len(y)
        gw = np.bincount(number, value * off_by[row], minlength=len(best)) + p.penalty / len(y) * vw
        w, b = vw - step * gw, vb - step * off_by.sum()
        t, was = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        vw, vb = w + (was - 1) / t * (w - lw), b + (was - 1) / t * (b - lb)
        lw, lb = w, b
    model.weights, model.intercept = w * ratio, float(b)
    return model


def is_held_out(doc_id: Column) -> Column:
    """Rows that no fit may learn from: crc32 of the id's text is divisible by five, or there is no id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit_on_labels(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    """A model of the labelled rows of docs that aren't held out; the sample is the least hashes of the ids of each class."""
    p = params
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic is not null")
    known = known.filter(~is_held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.max("toxic") >= 1).alias("toxic"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    present = Scratch(docs.sparkSession).table(known.join(texts.select("doc_id"), "doc_id", "left_semi"), "labelled")
    total, toxic = present.agg(F.count(F.lit(1)), F.count_if("toxic")).first()
    if not total or not 0 < toxic < total:
        return _constant(p.orders, toxic / total if total else 0)
    pick = lambda kind, most: present.filter(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    ids = pick(True, p.most_toxic).unionByName(pick(False, p.most_other))  # at most most_toxic + most_other ids: broadcast
    sampled = texts.join(F.broadcast(ids), "doc_id")
    # Sizes come first, one row for an id; only texts that fit in most_bytes are fetched.
    sizes = sampled.groupBy("doc_id").agg(F.min(F.struct(F.octet_length("text").alias("size"), F.xxhash64("text").alias("key"))).alias("x")).select("doc_id", "x.*").collect()
    fits, used = [], 0
    for r in sorted(sizes, key=lambda r: (r.key, r.doc_id)):
        if used + r.size <= p.most_bytes:
            used += r.size
            fits.append((r.doc_id, r.key))
    if not fits:
        return _constant(p.orders, toxic / total)
    fits = docs.sparkSession.createDataFrame(fits, "doc_id long, key long")
    sample = sampled.withColumn("key", F.xxhash64("text")).join(F.broadcast(fits), ["doc_id", "key"]).groupBy("doc_id").agg(F.first("text").alias("text"), F.first("toxic").alias("toxic")).toArrow().sort_by("doc_id")
    return fit(sample.column("text"), sample.column("toxic").to_numpy(zero_copy_only=False).astype(bool), toxic / total, p)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score), a row for each row of docs."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)  # at most `vocabulary` codes and weights

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held.value.scores(*utf8_parts(batch.column(1))))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")
