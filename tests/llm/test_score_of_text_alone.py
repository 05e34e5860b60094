"""A toxicity score and the fit depend on texts alone, not on their neighbours or their order."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quarrylens.llm import toxicity
from quarrylens.llm.common import utf8_parts

WORDS = "alpha beta gamma zork delta eps zeta été straße ΑΒΓ x".split()


def some_texts(n, seed=1):
    r = random.Random(seed)
    return [" ".join(r.choice(WORDS) for _ in range(r.randint(0, 12))) + r.choice(["", " ", "!", " zorkwit"]) for _ in range(n)] + ["", None, "   ", "a", "zork"]


def test_ngrams_match_brute_force():
    texts = some_texts(60)
    p = toxicity.ToxicityParams(least_texts=1, vocabulary=100_000)
    y = np.array([bool(t) and "zork" in t for t in texts])
    model = toxicity.fit(pa.array(texts), y, float(y.mean()), p)

    def grams(text):
        out, last = "", ""
        for c in f" {(text or '').lower()} ":
            c = c if "a" <= c <= "z" or "0" <= c <= "9" or ord(c) >= 0xC0 else " "
            if c != " " or last != " ":
                out += c
            last = c
        return {out[i : i + n] for n in p.orders for i in range(len(out) - n + 1)}

    def features(batch):
        row, number = model.features(*utf8_parts(pa.array(batch, pa.string())))
        return [set(number[row == k].tolist()) for k in range(len(batch))]

    whole, names = features(texts), {}
    for t, mine in zip(texts, whole, strict=True):
        assert features([t])[0] == mine
        assert len(mine) <= len(grams(t))
        for g in grams(t):
            names.setdefault(g, set(range(len(model.codes)))).intersection_update(mine)
    # A feature of a text is one of its own n-grams: an n-gram's code is in every text that holds it.
    for t, mine in zip(texts, whole, strict=True):
        assert mine <= set().union(*(names[g] for g in grams(t))) if grams(t) else not mine


def test_scores_do_not_depend_on_neighbours():
    texts = some_texts(200, 2)
    y = np.array([bool(t) and "zorkwit" in t for t in texts])
    model = toxicity.fit(pa.array(texts), y, float(y.mean()))
    together = model.scores(*utf8_parts(pa.array(texts)))
    assert together.tolist() == [float(model.scores(*utf8_parts(pa.array([t], pa.string())))[0]) for t in texts]
    assert together[::-1].tolist() == model.scores(*utf8_parts(pa.array(texts[::-1]))).tolist()


def test_fit_counts_labelled_documents_only(spark):
    texts = some_texts(300, 3)
    rows = [(i, t) for i, t in enumerate(texts)]
    labels = [(i, int(bool(t) and "zorkwit" in t)) for i, t in enumerate(texts)]
    frame = lambda r: spark.createDataFrame(r, "doc_id long, text string")
    marks = lambda r: spark.createDataFrame(r, "doc_id long, toxic int")
    a = toxicity.fit_on_labels(frame(rows), marks(labels))
    b = toxicity.fit_on_labels(frame(rows[::-1] + rows[:50]), marks(labels[::-1] + [(10_000 + i, 1) for i in range(5000)]))
    assert a.intercept == b.intercept and a.codes.tolist() == b.codes.tolist() and a.weights.tolist() == b.weights.tolist()
    small = toxicity.fit_on_labels(frame([*rows, (900, "y" * 100_000)]), marks([*labels, (900, 1)]), toxicity.ToxicityParams(most_bytes=20_000))
    assert small.intercept != 0 and len(small.codes)
    empty = frame([])
    assert toxicity.score_toxicity(empty, a).count() == 0
    assert toxicity.score_toxicity(frame(rows), toxicity.fit_on_labels(empty, marks(labels))).filter(F.col("score") > 0.001).count() == 0
