"""The manifest against trees built in plain Python; odd tables; proofs that fail when a byte changes."""

import hashlib
import zlib
from collections import Counter

from pyspark.sql import functions as F

from quarrylens.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree int, path string"
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r):
    return h(*["-" if r[c] is None else f"{len(str(r[c]).encode())}:{r[c]}" for c in merkle.COLUMNS])


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tree(nodes):
    """The root, and for each node its siblings (before, after) level by level."""
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, up_owners = [], []
        for a in range(0, len(nodes), 16):
            run = nodes[a : a + 16]
            for k in range(len(run)):
                for i in owners[a + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(h(*run))
            up_owners.append([i for o in owners[a : a + 16] for i in o])
        nodes, owners = up, up_owners
    return nodes[0], paths


def plain_audit(rows):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    if not sources:
        return []
    trees = {}
    for s in sources:
        by[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[s] = tree([leaf(r) for r in by[s]])
    root, tops = tree([trees[s][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for r, own in zip(by[s], trees[s][1], strict=True):
            path, other = own + tops[k], dict(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None:
                other["text"] = lowered(r["text"])
            node = leaf(other)
            for before, after in path:
                node = h(before, node, after)
            out.append((r["doc_id"], leaf(r), trees[s][0], root, h(*[a + b for a, b in path]), node, node == root))
    return out


def check(spark, rows):
    got = Counter(map(tuple, merkle.audit(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert got == Counter(plain_audit([dict(zip(NAMES, r, strict=True)) for r in rows]))
    return got


def test_many_sources_and_levels(spark):
    """Sources of 1 to 700 rows, a null one, more than 16 of them, an order that is not the alphabet's."""
    rows = [(i, f"Text É{i} " + "Ab" * (i % 7), "de", s, i, "x", 1, "p") for s, n in [(None, 17), ("", 1), ("Z", 16), ("ä", 257), ("z", 700), *((f"s{k}", 2) for k in range(14))] for i in range(-3, n - 3)]
    got = check(spark, rows)
    assert len(got) == len(rows) and 0 < sum(not g[-1] for g in got) < len(rows)


def test_odd_rows(spark):
    """Nulls in all columns, repeated rows (a third of all, too), shared ids, empty and very long texts, clashing names."""
    odd = [(None, None, None, None, None, "x", 1, "p")] * 3 + [(1, "", "en", "a", 0, "x", 1, "p"), (1, "B", None, "a", 0, "x", 1, "p"), (7, "A" * 3_000_000, "en", "a", 9, "x", 1, "p")]
    check(spark, odd + [(5, "ABC", "en", "b", 3, "x", 1, "p")] * 40)
    check(spark, [(5, "ABC", "en", "b", 3, "x", 1, "p")])
    check(spark, [(i, "t", "en", "one", 3, "x", 1, "p") for i in range(16)])
    empty = merkle.audit(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and dict(empty.dtypes)["root"] == "string"


def test_store_and_proofs(spark):
    """The store has one folder for each level, in order of coordinates; a path with a changed byte gives another root."""
    rows = [(i, f"t{i}", "en", "a" if i % 3 else "b", i, "x", 1, "p") for i in range(300)]
    m = merkle.build(spark.createDataFrame(rows, SCHEMA))
    assert [level.count() for level in m.levels] == [2]
    assert m.runs.count() == 20 and m.subroots.count() == 2 and len(m.top) == 1
    proofs = merkle.proofs(m).withColumn("folded", merkle.fold(F.col("leaf"), F.col("path")))
    assert proofs.filter("folded = root").count() == 300
    wrong = F.transform("path", lambda s, k: F.when(k == 0, F.struct(F.concat(s["before"], F.lit("0")).alias("before"), s["after"].alias("after"))).otherwise(s))
    assert proofs.withColumn("folded", merkle.fold(F.col("leaf"), wrong)).filter("folded = root").count() == 0
