"""Collections' methods at their edges: absent keys, ranges, bounds, subtypes, nulls in multisets."""

import pytest
from pyspark.sql import functions as F

from quarrylens.functions import collections as co


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_associative(spark):
    t = F.create_map(*[F.lit(x) for x in (5, "e", 2, "b", 9, "i")])
    none = F.map_filter(t, lambda k, v: F.lit(False))
    assert tuple(one(spark, co.first(t), co.last(t), co.prior(t, F.lit(5)), co.prior(t, F.lit(2)), co.following(t, F.lit(3)), co.following(t, F.lit(9)))) == (2, 9, 2, None, 5, None)
    assert tuple(one(spark, co.first(none), co.last(none), co.exists(none, F.lit(1)), co.exists(t, F.lit(2)), F.size(co.delete(t, F.lit(77))), F.size(co.delete(t, F.lit(9), F.lit(2))))) == (None, None, False, True, 3, 3)
    assert one(spark, co.put(co.delete(t, F.lit(2), F.lit(5)), F.lit(9), F.lit("z")))[0] == {9: "z"}


def test_multisets(spark):
    a, b = F.array(*[F.lit(x) for x in (1, 1, 2)], F.lit(None).cast("int"), F.lit(None).cast("int")), F.array(F.lit(1), F.lit(3), F.lit(None).cast("int"))
    row = one(spark, co.union_all(a, b).alias("u"), co.intersect_all(a, b).alias("i"), co.except_all(a, b).alias("e"), co.submultiset(co.intersect_all(a, b), a).alias("s"), co.submultiset(a, b).alias("n"))
    assert (row.u, row.i, row.e, row.s, row.n) == ([1, 1, 2, None, None, 1, 3, None], [1, None], [1, 2, None], True, False)


def test_bounds_and_subtypes(spark):
    assert one(spark, co.bounded(F.array(F.lit(1), F.lit(2)), 2), co.subtype(F.lit("7"), "int", 1, 9), co.subtype(F.lit(None), "int", 1, 9))[1:] == (7, None)
    for bad in (co.bounded(F.array(F.lit(1), F.lit(2)), 1), co.subtype(F.lit(10), "int", 1, 9), co.subtype(F.lit(None), "int", not_null=True)):
        with pytest.raises(Exception, match="limit|out of range"):
            one(spark, bad)
