"""Every registered operator query on the smallest tables: against SQL where there is one, else against a plain version."""

import hashlib
import os
import zlib
from collections import Counter

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_license_windows import by_all_windows
from test_operators import bag, jaccard

import corpus_pipeline
from quarrylens.llm import chat, decontam, licenses, mixing, neardup, pii, quality, queries, secrets, sql, toxicity

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = queries.queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{DATA}/{name}')")
    return con


def docs():
    return pq.read_table(f"{DATA}/documents.parquet").to_pylist()


def plain(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


def rows_of(table):
    names = sorted(table.column_names)
    return names, Counter(tuple(map(plain, r)) for r in zip(*(table.column(c).to_pylist() for c in names), strict=True))


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    assert rows_of(QUERIES[name](spark, DATA).toArrow()) == rows_of(duck.execute(sql.oracle_sql()[name]).to_arrow_table())


def test_op1(spark):
    got = {r.doc_id: r for r in QUERIES["op1_toxicity"](spark, DATA).collect()}
    assert len(got) == len(docs()) and all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for i, r in got.items())


def test_op2(spark):
    s, got = pii.Surrogates(), {r.doc_id: r for r in QUERIES["op2_pii"](spark, DATA).collect()}
    for d in docs():
        text, counts = s.scrub(d["text"])
        assert got[d["doc_id"]].text == text and all(got[d["doc_id"]][f"n_{k}"] == counts.get(k, 0) for k in pii.TYPES)


def test_op3(spark):
    a, turns = chat.Automaton(), {}
    for t in pq.read_table(f"{DATA}/conversations.parquet").to_pylist():
        turns.setdefault(t["conv_id"], []).append((t["turn"], t["role"], t["text"]))
    got = Counter((r.conv_id, r.out_turn) for r in QUERIES["op3_chat"](spark, DATA).collect())
    for conv, rows in turns.items():
        m = a.matrix([chat.known_role(r) for _, r, _ in sorted(rows, key=lambda x: x[0])])[chat.START]
        least = min((c + a.ends[s][0], t + a.ends[s][1]) for s, (c, t) in enumerate(m) if c != float("inf"))
        assert len({k for k in got if k[0] == conv}) == least[1]


def test_op5(spark):
    got = {r.doc_id: r.class_id for r in QUERIES["op5_neardup"](spark, DATA).collect()}
    bags = {d["doc_id"]: bag(d["text"]) for d in docs()}
    label = {i: i for i in bags}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in bags:
        for j in bags:
            if i < j and bags[i] and bags[j] and min(sum(bags[i].values()), sum(bags[j].values())) >= 0.8 * max(sum(bags[i].values()), sum(bags[j].values())) and jaccard(bags[i], bags[j]) >= 0.8:
                x, y = sorted((top(i), top(j)))
                label[y] = x
    assert got == {i: top(i) for i in bags}


def test_op6(spark):
    got = {r.doc_id: set(r.licenses.split(",")) - {""} for r in QUERIES["op6_licenses"](spark, DATA).collect()}
    assert got == {d["doc_id"]: by_all_windows(d["text"], licenses.TEMPLATES) for d in docs()}


def test_op7(spark):
    forest = secrets.train(spark)
    got = QUERIES["op7_secrets"](spark, DATA).collect()
    texts = {d["doc_id"]: d["text"] or "" for d in docs()}
    features = {(r.doc_id, r.position): (r.token, r.f) for r in secrets.candidates(spark.read.parquet(f"{DATA}/documents.parquet")).collect()}
    assert len(got) == len(features)
    for r in got:
        token, f = features[r.doc_id, r.position]
        assert token in texts[r.doc_id] and hashlib.sha256(token.encode()).hexdigest() == r.digest
        assert abs(forest.score([f[k] for k in secrets.FEATURES]) - r.score) < 1e-6 and r.secret == (r.score >= 0.5)


def test_pipeline(spark, duck):
    """Each stage on what its predecessor kept, against the operators' own verdicts."""
    source = spark.read.parquet(f"{DATA}/documents.parquet")
    out = corpus_pipeline.run(spark, DATA)
    kept = {r.doc_id for r in QUERIES["op8_quality"](spark, DATA).filter("kept").collect()}
    texts = {d["doc_id"]: d["text"] for d in docs() if d["doc_id"] in kept}
    first = source.filter(F.col("doc_id").isin(*kept))
    best: dict[int, int] = {}
    for r in neardup.near_duplicate_classes(first).collect():
        best[r.class_id] = min(r.doc_id, best.get(r.class_id, r.doc_id))
    second = first.filter(F.col("doc_id").isin(*best.values()))
    clean = {r.doc_id for r in decontam.scan_benchmark(second, spark.read.parquet(f"{DATA}/benchmark.parquet")).filter("not contaminated").collect()}
    third = pii.scrub(second.filter(F.col("doc_id").isin(*clean)))
    want = {r.doc_id: r.copies for r in mixing.mix(third).collect() if r.copies}
    rows = out.collect()
    assert Counter(r.doc_id for r in rows) == want and out.columns == [*source.columns, "copy"]
    s = pii.Surrogates()
    assert all(r.text == s.scrub(texts[r.doc_id])[0] for r in rows)


CASES = "doc_id long, text string, lang string, source string, n_chars long, score double, copy string, m int, kept boolean, size long, key string, row string, n_email int, fp string"


def test_stages_on_odd_tables(spark, tmp_path):
    """Nulls in all columns, empty and very long texts, repeated rows, clashing names, no rows."""
    row = lambda i, t, lang="en", source="a": (i, t, lang, source, None, 0.5, "c", 1, True, 3, "k", "r", 1, "f")
    good = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu call 415-555-2671 now"
    long = " ".join(f"word{i}" for i in range(60_000))
    table = [row(1, good), row(1, good), row(1, good), row(None, good), row(None, None, None, None), row(2, ""), row(3, long), row(4, long + " end"), row(5, good + " one two three four five six seven", None, None), row(None, "ten other words that are here for a null id only once more", None, "b")]
    folder = str(tmp_path)
    documents = spark.createDataFrame(table, CASES)
    spark.createDataFrame([(1, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "one two three four five six seven"), (None, None), (None, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for docs_ in (documents, documents.limit(0)):
        now = docs_
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, folder)
            now.write.parquet(f"{folder}/{name}-{docs_.count()}")
            now = spark.read.parquet(f"{folder}/{name}-{docs_.count()}")
            assert now.columns[: len(documents.columns)] == documents.columns, name
        assert (now.count() > 0) == (docs_.count() > 0)
    # The repeated row and the null id's copy are one text: one row of it is left; the benchmark's text is out.
    left = spark.read.parquet(f"{folder}/scrub_personal_data-10").collect()
    assert Counter(r.doc_id for r in left) == {1: 1, 3: 1, None: 1} and all("415-555-2671" not in r.text for r in left)


def test_operators_on_odd_tables(spark):
    row = lambda i, t: (i, t, None, None, None, None, None, None, None, None, None, None, None, None)
    docs_ = spark.createDataFrame([row(None, None), row(None, None), row(7, "x"), row(7, "x"), row(8, "")], CASES)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    for part, n in ((docs_, 5), (docs_.limit(0), 0)):
        assert toxicity.score_toxicity(part, toxicity.fit_on_labels(part, labels)).count() == n
        assert decontam.scan_benchmark(part, bench).filter("not contaminated").count() == n
        assert neardup.near_duplicate_classes(part).count() == n
        assert licenses.scan_licenses(part).filter("n_licenses = 0").count() == n
        assert secrets.scan_secrets(part, secrets.Forest([0.0])).count() == 0
        assert quality.judge(part, labels).filter("not kept").count() == n
        assert mixing.mix(part).count() == n
        assert pii.scrub(part).count() == n
