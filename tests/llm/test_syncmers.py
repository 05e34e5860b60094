"""Fingerprints against a plain version of the whole rule, neighbours by id, likeness, odd tables."""

import hashlib
import random
from collections import Counter

import pyarrow.parquet as pq
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from quarrylens.llm import queries, syncmers

P = syncmers.SyncmerParams()
SINGLE = r"฀-࿿က-႟ក-៿぀-㆏ㇰ-ㇿ㐀-鿿ꥠ-꥿ꩠ-ꩿ가-퟿豈-﫿\U00020000-\U0003FFFF"
SYMBOLS = regex.compile(rf"(?:[0-9A-Za-zÀ-ÖØ-öø-ɏ]|(?![{SINGLE}])[\p{{L}}\p{{M}}\p{{N}}]){{1,64}}+|[^ \t\n\x0B\f\r]")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, n int, bucket int, print string"


def hashed(words):
    h = 42
    for w in words:
        h = xxhash.xxh64(w.encode(), seed=h).intdigest()
    return h


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def print_of(text, p=P):
    """The fingerprint, by looking at every window and all its inner substrings."""
    w = SYMBOLS.findall(text or "")
    if not w:
        return []
    if len(w) < p.k:
        return [(hashed([" ".join(w)]) & 0x7FFFFFFF) << 32]
    first = {}
    for i in range(len(w) - p.k + 1):
        inner = [signed(hashed(w[i + j : i + j + p.s])) for j in range(p.k - p.s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            first.setdefault(hashed(w[i : i + p.k]) & 0x7FFFFFFF, i)
    return sorted((c << 32) + i for c, i in first.items())[: p.prints]


def alike(a, b, p=P):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    left, right = ({x >> 32: x & 0xFFFFFFFF for x in y} for y in (a, b))
    weighed = sorted({*left, *right})[: p.prints]
    shifts = Counter(right[c] - left[c] for c in weighed if c in left and c in right)
    return sum(n for n in shifts.values() if n > 1 or len(weighed) < p.few) / len(weighed)


def plain_report(rows):
    """rows: (doc_id, text)."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest()))
    out = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        a, b, c = print_of(text), print_of(edited), print_of(after)
        words = lambda f: ",".join(f"{x:X}" for x in f)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), words(a), words(b), f"{alike(a, b):.9f}", f"{alike(a, c):.9f}"))
    return Counter(out)


def report(df):
    return Counter((*r[:5], f"{r.near_edited:.9f}", f"{r.near_next:.9f}") for r in syncmers.fingerprint_report(df).collect())


def test_query(spark):
    data = "/root/testdata/sf0.001"
    got = Counter((*r[:5], f"{r.near_edited:.9f}", f"{r.near_next:.9f}") for r in queries.queries()["op13_fingerprints"](spark, data).collect())
    assert got == plain_report([(d["doc_id"], d["text"]) for d in pq.read_table(f"{data}/documents.parquet").to_pylist()])


def test_odd_tables(spark):
    """Nulls, empty, blank and very long texts, scripts without spaces, shared ids, rows alike (a third of all, too), clashing names, one row, none."""
    rnd = random.Random(3)
    long = " ".join(rnd.choice(["ab", "cd", "éf", "漢字漢", "x" * 200, "1.5", "\n"]) for _ in range(60_000))
    texts = [None, "", "  \n", "a", "a b c d", "漢字かな交じり文と、ひらがな。" * 30, "𝔘𝔫𝔦 😀 code " * 50, "x" * 30_000, long, "one two three four five six seven eight nine ten", "ABC\x0b def g\x85h i j k l", "aaaa " * 300]
    rows = [(k % 9 - 4 if k % 5 else None, t, None, None, None, "k", 1, 2, "p") for k, t in enumerate(texts * 2)]
    for table in (rows, rows + [rows[9]] * 300, rows[4:5]):
        assert report(spark.createDataFrame(table, SCHEMA)) == plain_report([r[:2] for r in table])
    assert syncmers.fingerprint_report(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("piece", [3, 100])
def test_pieces(spark, piece):
    """A text weighed in pieces of any length has the same fingerprint, also after a beginning that is weighed apart."""
    p, text = syncmers.SyncmerParams(piece=piece), "The quick-brown fox; 漢字 über 12.5 jumps over " * 40
    weighed = syncmers.weigh(F.lit(text[:90]), p)
    row = spark.range(1).select(syncmers.fingerprint(F.lit(text), p).alias("a"), syncmers.finished(syncmers.weigh(F.lit(text[90:]), p, weighed), p).alias("b")).first()
    assert list(row.a) == print_of(text) == list(row.b) and text[89] == " "


def test_moved_passage(spark):
    """A passage that moves keeps its anchors at one shift; other texts of the same words don't."""
    rnd = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    passage, others = (" ".join(rnd.choice(words) for _ in range(n)) for n in (150, 600))
    texts = spark.createDataFrame([(passage, f"so it was : {passage}", others)], "a string, b string, c string").select(*[syncmers.fingerprint(F.col(c)).alias(c) for c in "abc"])
    row = texts.select(syncmers.likeness(F.col("a"), F.col("b")).alias("moved"), syncmers.likeness(F.col("a"), F.col("c")).alias("other"), syncmers.common_spans(F.col("a"), F.col("b")).alias("spans")).first()
    assert row.moved > 0.9 and row.other < 0.05 and [s["shift"] for s in row.spans] == [4]
