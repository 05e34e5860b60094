"""Hierarchies in plain Python against the operator: forests, several ways to a row, loops, odd keys."""

import random

import pytest
from pyspark.sql import functions as F

from quarrylens.operators.hierarchy import BREADTH, DEPTH, connect_by

SCHEMA = "id long, parent long, weight int, level string"


def plain(rows, start, nocycle=True):
    """(id, weight, depth, root, path, is_leaf, is_cycle) for each occurrence, depth first, siblings by falling weight and then id."""
    order = lambda r: (-r[2], r[0])
    out = []

    def visit(r, path, root):
        children = sorted((c for c in rows if c[1] is not None and c[1] == r[0]), key=order)
        inner = [c for c in children if c[0] not in path]
        out.append((r[0], r[2], len(path), root, tuple(path), not inner, len(inner) < len(children)))
        for c in inner:
            visit(c, [*path, c[0]], root)

    for r in sorted(filter(start, rows), key=order):
        visit(r, [r[0]], r[0])
    return out


def found(spark, rows, start, **options):
    df = connect_by(spark.createDataFrame([(*r, "kept") for r in rows], SCHEMA), "id", "parent", start, [F.desc("weight")], **options)
    return [(r.id, r.weight, r.level_, r.root, tuple(r.path), r.is_leaf, r.is_cycle) for r in df.orderBy("place").collect()], df


@pytest.mark.parametrize("seed", range(4))
def test_against_plain(spark, seed):
    """Trees, shared rows and loops; a column named like an added one is kept."""
    rnd = random.Random(seed)
    rows = [(k, rnd.choice([None, *range(max(0, k - 4), k)]), rnd.randrange(5)) for k in range(25)]
    if seed > 1:  # some rows twice, with another parent, and links back
        rows += [(k, rnd.randrange(25), rnd.randrange(5)) for k in rnd.sample(range(25), 4)]
    want = plain(rows, lambda r: r[1] is None)
    got, df = found(spark, rows, F.col("parent").isNull(), nocycle=True, search=DEPTH)
    key = lambda r: (r[4], r[0])
    assert sorted(got, key=key) == sorted(want, key=key) and df.filter("level = 'kept'").count() == len(want)
    if seed < 2:  # no ties but by id: the order is defined
        assert got == want
        level_wise = found(spark, rows, F.col("parent").isNull(), search=BREADTH)[0]
        assert level_wise == sorted(want, key=lambda r: r[2])


def test_odd_keys(spark):
    """Null ids and parents, a row that is its own parent, no start, no rows, a parent of very many, repeated rows."""
    rows = [(None, 1, 0), (1, None, 0), (2, 2, 0), (None, None, 1), (3, 1, 0), (3, 1, 0)] + [(10 + k, 1, 0) for k in range(500)]
    got, _ = found(spark, rows, F.col("id") == 1, nocycle=True, search=DEPTH)
    assert len(got) == 1 + 1 + 2 + 500 and sum(r[5] for r in got) == 503
    itself, _ = found(spark, rows, F.col("id") == 2, nocycle=True, search=DEPTH)
    assert itself == [(2, 0, 1, 2, (2,), True, True)]
    with pytest.raises(ValueError, match="loop"):
        found(spark, rows, F.col("id") == 2, search=DEPTH)
    assert found(spark, rows, F.col("id") == 7777, search=DEPTH)[0] == [] and found(spark, [], F.col("id") == 1, search=DEPTH)[0] == []


def test_most_levels(spark):
    rows = [(k, k - 1 if k else None, 0) for k in range(6)]
    got, _ = found(spark, rows, F.col("parent").isNull(), most_levels=3, search=DEPTH)
    assert [(r[0], r[2], r[5]) for r in got] == [(0, 1, False), (1, 2, False), (2, 3, False)]
