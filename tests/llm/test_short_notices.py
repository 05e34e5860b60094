"""License notices of one to four words inside longer texts."""

from quarrylens.llm import licenses


def test_short_notices_inside_a_text(spark):
    long = " ".join(f"w{i}" for i in range(700))
    texts = [f"{long} all rights RESERVED. {long}", "Code under the MIT License, see above", "we use gplv3 here", "All rights reserved", "rights reserved for all", "Copyright 2020 X. All rights", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.licenses, r.containment, r.first_word) for r in licenses.scan_licenses(docs).collect()}
    assert [got[i] for i in range(4)] == [("Proprietary", 1.0, 700), ("MIT", 1.0, 3), ("GPL-3.0", 1.0, 2), ("Proprietary", 1.0, 0)]
    assert all(got[i][0] == "" for i in (4, 5, 6))
    own = {r.doc_id: r.licenses for r in licenses.scan_licenses(docs, {"A": ["rights reserved"], "B": ["rights reserved"], "C": ["w1 w2 w3 w4 w5 w6"]}).collect()}
    assert own == {0: "A,B,C", 1: "", 2: "", 3: "A,B", 4: "A,B", 5: "", 6: ""}
