"""Texts that share a bucket and are all equally unlike its centre are told apart by their masks, and no true link is lost."""

import numpy as np
import pytest

from quarrylens.llm import neardup as nd


@pytest.fixture(scope="module")
def texts():
    rng, base = np.random.default_rng(4), [f"w{k}" for k in range(60)]
    out = []
    for _ in range(120):
        words = list(base)
        for at in rng.integers(0, 60, rng.integers(1, 4)):
            words[at] = f"z{rng.integers(40)}"
        out.append(" ".join(words))
    return sorted(set(out))


def bags(spark, texts):
    made = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1).mapInArrow(nd._shingler(nd.NearDupParams()), "fp string, bag array<long>, mask array<long>")
    return made.collect()


def test_mask_leaves_out_only_pairs_below_the_threshold(spark, texts):
    rows, wide, narrow = bags(spark, texts), 0, 0
    for i, a in enumerate(rows):
        for b in rows[:i]:
            both = len(set(a.bag) & set(b.bag))
            alike = both / (len(a.bag) + len(b.bag) - both)
            apart = sum((x ^ y) % 2**64 for x, y in zip(a.mask, b.mask, strict=True)) and sum(((x ^ y) % 2**64).bit_count() for x, y in zip(a.mask, b.mask, strict=True))
            fits = apart <= (len(a.bag) + len(b.bag)) * (0.2 / 1.8) + 1e-6
            assert fits or alike < 0.8
            wide, narrow = wide + (alike < 0.8), narrow + (not fits)
    assert narrow > 0.9 * wide > 0  # nearly all of what is below is never compared exactly


def test_classes_are_those_of_all_pairs(spark, texts):
    rows = bags(spark, texts)
    up = list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            both = len(set(a.bag) & set(b.bag))
            if both >= 0.8 * (len(a.bag) + len(b.bag) - both):
                up[root(i)] = root(j)
    found = {r.fp: r.class_id for r in nd.near_duplicate_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    named = {}
    for k, r in enumerate(rows):
        named.setdefault(root(k), set()).add(found[r.fp])
    assert all(len(x) == 1 for x in named.values()) and len(set.union(*named.values())) == len(named)
