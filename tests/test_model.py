"""Models: what is updated, added, refused; orders, references, iterations, nulls."""

import pytest

from quarrylens.operators.model import ANY, Model, Rule

SCHEMA = "p string, d int, e string, x bigint"


def solved(spark, rows, rules, **options):
    model = Model(["p"], ["d", "e"], {"x": "bigint", "y": "double"}, rules, **options)
    return {tuple(r)[:3]: tuple(r)[3:] for r in model.apply(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_targets_and_upsert(spark):
    rows = [("a", 1, "u", 10), ("a", 2, "u", 20), ("a", 2, "v", 5), (None, 1, "u", None), ("a", None, "u", 3)]
    rules = [
        Rule("x", {"d": [7, 8], "e": "u"}, lambda c: c("x", d=c.cv("d") - 6)),  # FOR, added
        Rule("x", {"d": 9, "e": "u"}, lambda c: 1, upsert=False),  # not there: nothing happens
        Rule("y", {"d": lambda d: d is not None and d >= 2, "e": ANY}, lambda c: c("x") / 2),
        Rule("y", {"d": None, "e": "u"}, lambda c: c.over(max, "x", d=ANY) + (100 if c.present(d=8) else 0)),
    ]
    got = solved(spark, rows, rules)
    assert got == {
        ("a", 1, "u"): (10, None), ("a", 2, "u"): (20, 10.0), ("a", 2, "v"): (5, 2.5), ("a", None, "u"): (3, 120.0), ("a", 7, "u"): (10, 5.0), ("a", 8, "u"): (20, 10.0),
        (None, 1, "u"): (None, None), (None, 7, "u"): (None, None), (None, 8, "u"): (None, None), (None, None, "u"): (None, None),
    }


def test_orders(spark):
    rows = [("a", d, "u", 1) for d in range(1, 6)]
    double = lambda step: Rule("x", {"d": ANY}, lambda c: c("x") + (c("x", d=c.cv("d") + step) or 0), descending=step > 0)
    assert [solved(spark, rows, [double(-1)])["a", d, "u"][0] for d in range(1, 6)] == [1, 2, 3, 4, 5]
    assert [solved(spark, rows, [double(1)])["a", d, "u"][0] for d in range(1, 6)] == [5, 4, 3, 2, 1]
    with pytest.raises(Exception, match="depend on one another"):
        solved(spark, rows, [Rule("x", {"d": ANY}, lambda c: c("y")), Rule("y", {"d": ANY}, lambda c: c("x"))], automatic=True)


def test_iteration(spark):
    rule = Rule("x", {"d": 1, "e": "u"}, lambda c: c("x") * 2)
    got = solved(spark, [("a", 1, "u", 1), ("b", 1, "u", 3)], [rule], iterate=50, until=lambda c: c("x", d=1, e="u") - c.previous("x", d=1, e="u") >= 8)
    assert got["a", 1, "u"][0] == 16 and got["b", 1, "u"][0] == 24


def test_refusals_and_no_rows(spark):
    with pytest.raises(ValueError, match="one cell"):
        solved(spark, [("a", 1, "u", 1), ("a", 1, "u", 2)], [])
    with pytest.raises(ValueError, match="cells"):
        solved(spark, [("a", k, "u", 1) for k in range(5)], [], most_cells=4)
    assert solved(spark, [], [Rule("x", {"d": 1, "e": "u"}, lambda c: 1)]) == {}
