"""Tables that change: which parts a statement writes, versions by time, two writers, triggers' points, refreshed groups, odd rows."""

import os
import time
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from quarrylens.operators import change_queries, dml

ROWS = [(1, "a", 5), (2, "a", 6), (3, "b", 7), (4, None, 8), (None, "b", 9)]
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def made(spark, tmp_path):
    def make(name="t", **options):
        table = dml.ChangingTable(spark, f"file://{tmp_path}", name, **options)
        table.write(spark.createDataFrame(ROWS, "k int, p string, x int"))
        return table

    return make


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def folders(table, part):
    return [p for name, p in table._version()["folders"] if name == part]


def test_only_touched_parts_are_written(spark, made):
    t = made(layout=dml.by_list("p"))
    kept, null = folders(t, "b"), folders(t, "null")
    assert len(t._version()["folders"]) == 3
    t.update({"x": F.col("x") + 1}, F.col("p") == "a")
    assert folders(t, "b") == kept and folders(t, "null") == null
    t.insert(spark.createDataFrame([(9, "b", 1)], "k int, p string, x int"))
    assert set(folders(t, "b")) > set(kept)
    t.update({"p": F.lit("c")}, F.col("k") == 4)  # moves to a part of its own
    assert not folders(t, "null") and len(folders(t, "c")) == 1
    t.delete(F.col("k") == 12345)
    assert rows(t.read()) == sorted([(1, "a", 6), (2, "a", 7), (3, "b", 7), (4, "c", 8), (None, "b", 9), (9, "b", 1)], key=str)
    s = spark.createDataFrame([(3, 70), (10, 80)], "k int, x int")
    before = folders(t, "a"), folders(t, "c")
    t.merge(s, ["k"], {"x": F.col("s.x")}, {"k": F.col("s.k"), "p": F.lit("b"), "x": F.col("s.x")})
    assert (folders(t, "a"), folders(t, "c")) == before and {(3, "b", 70), (10, "b", 80)} <= set(rows(t.read()))


def test_layouts(spark, made):
    parts = lambda layout: {r[0] for r in spark.createDataFrame([(1, "2024-01-31 10:00:00"), (250, "2024-02-01 00:00:00"), (None, None)], "n int, at string").withColumn("at", F.to_timestamp("at")).select(layout.of()).collect()}
    assert parts(dml.by_range("n", bounds=[100, 200])) == {"0", "2", "null"} and parts(dml.by_range("n", interval=100)) == {"0", "200", "null"}
    assert parts(dml.by_range("at", interval="month")) == {"2024-01-01", "2024-02-01", "null"}
    assert parts(dml.composite(dml.by_range("n", interval=100), dml.by_hash(["n"], 1))) == {"0-0", "200-0", "null-0"}


def test_join_of_buckets_has_no_exchange(spark):
    joined = change_queries.joined_buckets(spark, DATA)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_versions_by_time_and_two_writers(spark, made):
    t = made()
    time.sleep(0.01)
    between = datetime.now(timezone.utc)
    time.sleep(0.01)
    other = dml.ChangingTable(spark, t.root, "t")
    seen = other._version()
    t.update({"x": F.lit(0)}, F.col("k") == 1)
    assert (1, "a", 5) in rows(t.read(as_of=between)) and (1, "a", 0) in rows(t.read())
    with pytest.raises(dml.ConcurrentChange):
        other._commit(seen, seen["folders"], t.read().schema)
    assert (1, "a", 0) in rows(other.read()) and len(other.history()) == 2
    with pytest.raises(LookupError):
        t.read("1999-01-01T00.00.00.000000Z")
    t.add_column("y", "int")
    assert t.read().columns == ["k", "p", "x", "y"] and t.read().filter("y is null").count() == 5
    t.truncate()
    assert t.read().count() == 0 and t.insert(spark.createDataFrame([(1,)], "k int"), {"x": F.lit(3)}) and rows(t.read()) == [(1, None, 3, None)]


def test_changes_between(made):
    t = made(layout=dml.by_list("p"))
    a = t._version()["run_version"]
    t.update({"x": F.lit(7)}, F.col("p") == "b")  # k 3 has 7 already
    t.delete(F.col("k") == 1)
    found = {(r.op, (r.old or r.new).k, r.new and r.new.x) for r in t.changes_between(a, t._version()["run_version"], ["k"]).collect()}
    assert found == {("UPDATE", None, 7), ("DELETE", 1, None)}
    assert t.versions_between(a, a, ["k"]).count() == 0


def test_trigger_points(spark, made):
    said = []
    audit = made("audit")
    audit.truncate()
    raised = dml.Trigger(
        events=frozenset({dml.UPDATE}), of=("x",), when=lambda old, new: new("k") != 2, before_statement=lambda state: said.append("before") or state.update(n=3),
        before_row=lambda old, new, state: {"x": new("x") + state["n"]}, after_row=lambda old, new, state: {"k": new("k"), "p": new("p"), "x": new("x") - old("x")}, into=audit,
        after_statement=lambda state, changes: said.append((state["n"], changes.count())),
    )
    refuse = dml.Trigger(check=lambda old, new, state: [(new("x") > 100, "too much")])
    t = made(triggers=[raised, refuse])
    version, changed = t.update({"x": F.col("x") * 2}, F.col("p") == "a")
    assert rows(changed) == [(1, "a", 13), (2, "a", 12)] and rows(audit.read()) == [(1, "a", 8)] and said == ["before", (3, 2)]
    t.update({"p": F.lit("z")}, F.col("k") == 3)  # x doesn't change: no row of the first trigger
    assert rows(audit.read()) == [(1, "a", 8)]
    with pytest.raises(ValueError, match="too much"):
        t.insert(spark.createDataFrame([(8, "a", 101)], "k int, p string, x int"))
    assert t.read().filter("k = 8").count() == 0 and t.delete(F.col("k") == 1) and t.read().count() == 4


def test_only_changed_groups_are_refreshed(spark, made):
    base = made(layout=dml.by_list("p"))
    view = dml.GroupedView(base, ["k"], ["p"], [F.sum("x").alias("x")], dml.ChangingTable(spark, base.root, "view", dml.by_list("p")))
    view.refresh()
    kept = folders(view.table, "a")
    base.delete(F.col("k") == 4)
    base.insert(spark.createDataFrame([(7, "b", 1), (8, "n", 2)], "k int, p string, x int"))
    view.refresh()
    assert rows(view.table.read()) == sorted([("a", 11), ("b", 17), ("n", 2)], key=str) and folders(view.table, "a") == kept
    assert rows(view.refreshed[-1]) == sorted([("b",), ("n",), (None,)], key=str)
    view.refresh()
    assert rows(view.refreshed[-1]) == [] and view.table.read().count() == 3
