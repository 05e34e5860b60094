"""Non-ASCII white space belongs to words, in items as in documents."""

from quarrylens.llm import decontam


def test_items_with_other_white_space(spark):
    spaces = [chr(x) for x in (0xA0, 0x202F, 0x3000, 0x85, 0x2028)]
    items = [f"vu est{s}ce ?" for s in spaces] + [f"a b c d e f g h{s}i j k l m" for s in spaces]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [f"x {t} y" for t in items] + ["vu est ce ?", "a b c d e f g h i j k l m"]
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontam.scan_benchmark(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), bench).collect()}
    assert [got[i] for i in range(5)] == [(4, 2, 1)] * 5
    assert [got[i] for i in range(5, 10)] == [(14, 12, 1)] * 5
    assert got[10] == (3, 0, 0) and got[11] == (13, 0, 0)
