"""Classes do not depend on ids: null ids and ids that different texts share."""

from collections import Counter

from quarrylens.llm import neardup


def test_null_and_shared_ids_join_nothing(spark):
    text = lambda k: " ".join(f"{k}w{i}" for i in range(40))
    rows = [(None, text("a")), (None, text("b")), (None, text("b").upper()), (None, text("c")), (None, None), (None, "."), (1, text("d")), (1, text("e")), (2, text("e")), (3, text("f")), (3, None), (4, text("g")), (5, text("g"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = Counter((r.doc_id, r.text and r.text.lower()) for r in neardup.keep_one_per_class(docs).collect())
    assert kept == Counter([(None, text("a")), (None, text("b")), (None, text("c")), (None, None), (None, "."), (1, text("d")), (1, text("e")), (3, text("f")), (3, None), (4, text("g"))])
    got = neardup.near_duplicate_classes(docs).collect()
    assert len(got) == len(rows)
    names = {}
    for r in got:
        if r.fp:
            names.setdefault(r.class_id, set()).add(r.fp)
    assert None not in names and len(names) == 7 and all(len(x) == 1 for x in names.values())
    assert {r.class_id for r in got if r.doc_id in (4, 5)} == {4} and sum(n < 0 for n in names) == 6
    assert sorted((r.doc_id, r.class_id) for r in got if not r.fp and r.doc_id) == [(3, 3)]
