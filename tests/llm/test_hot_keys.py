"""Splitting of hot keys changes no result."""

import random
from collections import Counter

from pyspark.sql import functions as F

from quarrylens.llm import common, neardup

from test_operators import WORDS, bag, classes_by_pairs, jaccard


def test_split_join_is_the_join(spark):
    left = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    right = spark.range(0, 6000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v")).union(spark.createDataFrame([(7, 1)], "k long, v long"))
    hot = common.hot_in(left, ["k"])
    assert [r.k for r in hot.collect()] == [7] and hot.first().slices > 1
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = common.split_join(left, right, ["k"], how, hot, F.col("id"))
        assert Counter(map(tuple, got.select(sorted(got.columns)).collect())) == Counter(map(tuple, (w := left.join(right, ["k"], how)).select(sorted(w.columns)).collect()))


def test_large_groups_and_left_over_texts(spark):
    """Many copies, one large group of near copies, and texts that share a bucket with it but belong to others."""
    r = random.Random(12)
    base = [r.choice(WORDS) + str(r.randint(0, 30)) for _ in range(40)]
    texts = [" ".join(base)] * 120
    for k in range(130):
        w = list(base)
        for _ in range(r.choice([0, 1, 1, 2, 3, 4])):
            w[r.randrange(len(w))] = f"e{r.randint(0, 9)}"
        texts.append(" ".join(w))
    texts += [" ".join(base[:20] + [f"o{k}{j}" for j in range(9)] + ["end"] * (j2 % 2)) for k in range(6) for j2 in range(4)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {x.doc_id: x.class_id for x in neardup.near_duplicate_classes(docs, neardup.NearDupParams(block=7)).collect()}
    assert [got[i] for i in range(len(texts))] == classes_by_pairs(texts)
    assert neardup.keep_one_per_class(docs).count() == len(set(got.values()))


def test_recall_of_links(spark):
    """Pairs at the threshold or above are in one class: nearly all, as 25 bands of 5 promise."""
    r = random.Random(13)
    texts = []
    for _ in range(150):
        w = [f"{r.choice(WORDS)}{r.randint(0, 99)}" for _ in range(r.randint(12, 90))]
        texts.append(" ".join(w))
        v = list(w)
        for _ in range(max(1, len(v) // 55)):
            v[r.randrange(len(v))] = "changed"
        texts.append(" ".join(v))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.class_id for x in neardup.near_duplicate_classes(docs).collect()}
    pairs = [(i, i + 1) for i in range(0, 300, 2) if jaccard(bag(texts[i]), bag(texts[i + 1])) >= 0.8]
    assert len(pairs) > 60 and sum(got[a] == got[b] for a, b in pairs) >= 0.99 * len(pairs)
