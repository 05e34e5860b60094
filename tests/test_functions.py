"""Aggregates with a state and table functions over tables: against plain versions, over many tasks and small batches, odd keys."""

import random
from collections import Counter
from dataclasses import replace
from datetime import datetime, timedelta

import pytest

from quarrylens.functions import aggregates, tables


def plain_top(values, n):
    values = sorted((v for v in values if v is not None), reverse=True)
    kept = [v for v in values if sum(w > v for w in values) < n]
    return [(v, c) for v, c in sorted(Counter(kept).items(), reverse=True)]


@pytest.mark.parametrize("most_states", [2, 100_000])
def test_states(spark, most_states):
    """A hot key, a null key, null values, two key columns; states passed on early give the same."""
    rnd = random.Random(1)
    rows = [(rnd.choice(["hot"] * 20 + ["a", "b", None]), rnd.choice([1, 2**60, None]), rnd.choice([None, *range(30)])) for _ in range(3_000)]
    df = spark.createDataFrame(rows, "k string, j bigint, x bigint").repartition(7)
    by = {}
    for k, j, x in rows:
        by.setdefault((k, j), []).append(x)
    top = aggregates.top_with_ties(3)
    top = replace(top, most_states=most_states)
    got = {(r.k, r.j): [(t.value, t.rows) for t in r.top] for r in top.by(df, ["k", "j"], ["x"]).collect()}
    assert got == {key: plain_top(values, 3) for key, values in by.items()}


def test_whole_table_and_no_rows(spark):
    df = spark.range(10).selectExpr("id AS x")
    top = aggregates.top_with_ties(2)
    assert [[(t.value, t.rows) for t in r.top] for r in top.by(df, [], ["x"]).collect()] == [[(9, 1), (8, 1)]]
    assert [r.top for r in top.by(df.limit(0), [], ["x"]).collect()] == [[]]
    assert top.by(df.selectExpr("x AS k", "x").limit(0), ["k"], ["x"]).collect() == []


def test_sessions(spark):
    """Batches of three rows, events without a time, a user with one event, ties."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rnd, start = random.Random(2), datetime(2024, 1, 1)
        rows = [(rnd.choice([1, 1, 1, 2, None]), start + timedelta(minutes=rnd.choice([0, 10, 29, 30, 31, 400]) * k)) for k in range(60)] + [(3, start), (4, None)]
        got = {(r.user, r.started, r.ended, r.events) for r in tables.sessions(spark.createDataFrame(rows, "user bigint, ts timestamp_ntz")).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = set()
    for user in {u for u, _ in rows}:
        times = sorted(t for u, t in rows if u == user and t)
        run = []
        for t in times:
            if run and t - run[-1] > timedelta(minutes=30):
                want.add((user, run[0], run[-1], len(run)))
                run = []
            run.append(t)
        if run:
            want.add((user, run[0], run[-1], len(run)))
    assert got == want
