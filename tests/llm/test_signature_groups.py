"""A text's signature is the same to the bit alone and among others."""

import numpy as np

from quarrylens.llm import neardup


def test_signature_does_not_depend_on_the_batch():
    r = np.random.default_rng(2)
    n, m = 600, neardup.NearDupParams().m
    counts = r.integers(5, 40, n)
    row = np.repeat(np.arange(n), counts)
    element, weight = r.integers(0, 2**44, len(row)).astype(np.uint64), r.integers(1, 6, len(row))
    together = neardup.bag_signature(row, element, weight, n, m)
    for k in range(n):
        own = row == k
        assert (neardup.bag_signature(row[own] * 0, element[own], weight[own], 1, m)[0] == together[k]).all()
