"""Collections of a schema's code as columns: associative tables with their methods, bounded arrays, multisets with repeats, and subtypes.

An associative table is a map; its methods go by the order of its keys, as the analysed dialect's do. All are expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _keys(table: Column) -> Column:
    return F.sort_array(F.map_keys(table))


def first(table: Column) -> Column:
    return F.get(_keys(table), F.lit(0))


def last(table: Column) -> Column:
    return F.array_max(F.map_keys(table))


def prior(table: Column, key: Column) -> Column:
    """The greatest key before key, which need not be there; null if there is none."""
    return F.array_max(F.filter(F.map_keys(table), lambda k: k < key))


def following(table: Column, key: Column) -> Column:
    """NEXT: the least key after key."""
    return F.array_min(F.filter(F.map_keys(table), lambda k: k > key))


def exists(table: Column, key: Column) -> Column:
    return F.coalesce(F.map_contains_key(table, key), F.lit(False))


def delete(table: Column, low: Column, high: Column | None = None) -> Column:
    """DELETE(low) or DELETE(low, high): keys that aren't there are no error, and a range the wrong way round is empty."""
    return F.map_filter(table, lambda k, v: (k < low) | (k > (low if high is None else high)))


def put(table: Column, key: Column, value: Column) -> Column:
    return F.map_concat(F.map_filter(table, lambda k, v: k != key), F.create_map(key, value))


def bounded(values: Column, limit: int) -> Column:
    """A VARRAY: an error where it has more values than its limit."""
    return F.when(F.size(values) > limit, F.raise_error(F.lit(f"subscript outside of limit: more than {limit} values"))).otherwise(values)


def subtype(value: Column, kind: str, low=None, high=None, not_null: bool = False) -> Column:
    """A value of a declared SUBTYPE: cast to its base and held to its RANGE and NOT NULL; an error otherwise."""
    out = value.cast(kind)
    bad = F.lit(False)
    if low is not None:
        bad = bad | (out < F.lit(low))
    if high is not None:
        bad = bad | (out > F.lit(high))
    if not_null:
        bad = bad | out.isNull()
    return F.when(F.coalesce(bad, F.lit(False)), F.raise_error(F.lit(f"value out of range of a subtype of {kind}"))).otherwise(out)


# Multisets: arrays whose repeats count. Nulls equal each other, as in the dialect's multiset operators.
def _count(values: Column, x: Column) -> Column:
    return F.size(F.filter(values, lambda y: y.eqNullSafe(x)))


def _times(values: Column, number) -> Column:
    """Each distinct value as often as number says, in the order of first appearance."""
    return F.flatten(F.transform(F.array_distinct(values), lambda x: F.array_repeat(x, number(x))))


def union_all(a: Column, b: Column) -> Column:
    return F.concat(a, b)


def intersect_all(a: Column, b: Column) -> Column:
    return _times(a, lambda x: F.least(_count(a, x), _count(b, x)))


def except_all(a: Column, b: Column) -> Column:
    return _times(a, lambda x: F.greatest(_count(a, x) - _count(b, x), F.lit(0)))


def submultiset(a: Column, b: Column) -> Column:
    """a SUBMULTISET OF b."""
    return F.forall(F.array_distinct(a), lambda x: _count(a, x) <= _count(b, x))
