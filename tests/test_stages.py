"""Stage commands with their exit codes, tables that change, numbering, JDBC, and the plans of some queries."""

import json
import os

import pytest
from pyspark.sql import functions as F

from quarrylens import cli, registry
from quarrylens.operators import banking as b, dml
from quarrylens.plans import rules as ru
from quarrylens.plans.cut import row_numbers
from quarrylens.sources import inventory as inv, runs

SOURCE = """CREATE TABLE acct (id NUMBER(9) PRIMARY KEY, balance NUMBER(18,2));
CREATE OR REPLACE PROCEDURE sp_pay_out(p_id IN NUMBER, p_amt IN NUMBER) IS
BEGIN
  IF p_amt <= 0 THEN
    RAISE_APPLICATION_ERROR(-20001, 'no');
  END IF;
  UPDATE acct SET balance = balance - p_amt WHERE id = p_id;
END sp_pay_out;
/
"""


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    root = tmp_path_factory.mktemp("source")
    (root / "a.sql").write_text(SOURCE)
    return str(root)


def ran(spark, source, out, *words):
    import argparse

    said = []
    args = argparse.Namespace(stage=words[0], question=words[1] if len(words) > 1 else None, source=source, out=str(out), annotations=None, rows=10)
    return cli.run(spark, args, said.append), said


@pytest.mark.parametrize("stage, table", [("inventory", "files"), ("rules", "rules")])
def test_stages_write_runs(spark, source, tmp_path, stage, table):
    code, said = ran(spark, source, tmp_path, stage)
    assert code == runs.EXIT_OK and json.loads(said[0])["rows"][table] >= 1
    assert runs.load_run(spark, str(tmp_path), stage, table).count() == json.loads(said[0])["rows"][table]


def test_questions_and_refusals(spark, source, tmp_path):
    code, said = ran(spark, source, tmp_path, "ask", "What is the calling interface of pay out?")
    assert code == runs.EXIT_OK and [r["name"] for r in json.loads(said[0])["rows"]] == ["P_ID", "P_AMT"]
    code, said = ran(spark, source, tmp_path, "ask", "What is the weather like?")
    assert code == runs.EXIT_REFUSED and len(json.loads(said[0])["suggestions"]) == 12
    empty = tmp_path / "none"
    empty.mkdir()
    assert ran(spark, str(empty), tmp_path, "inventory")[0] == runs.EXIT_INVALID


def table(spark, tmp_path):
    t = dml.ChangingTable(spark, f"file://{tmp_path}", "t")
    t.write(spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string"))
    return t


def test_merge_keeps_null_keys_and_refuses_two_sources(spark, tmp_path):
    t = table(spark, tmp_path)
    before = runs.latest(spark, f"file://{tmp_path}", "t")["run_version"]
    s = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, v string")
    t.merge(s, ["k"], {"v": F.col("s.v")}, {"k": F.col("s.k"), "v": F.col("s.v")})
    assert sorted(map(str, map(tuple, t.read().collect()))) == sorted(map(str, [(1, "a"), (2, "B"), (3, "C"), (None, "n"), (None, "N")]))
    assert t.read(before).count() == 3
    with pytest.raises(ValueError):
        t.merge(spark.createDataFrame([(2, "x"), (2, "y")], "k int, v string"), ["k"], {"v": F.col("s.v")})
    assert t.read().count() == 5
    t.delete(F.col("k") > 1)
    assert sorted(r.v for r in t.read().collect()) == ["N", "a", "n"]


def test_reading_over_jdbc(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    rows = spark.range(100).select(F.col("id").cast("int").alias("ID"))
    try:
        rows.write.format("jdbc").option("url", url).option("dbtable", "LINKED").option("driver", "org.apache.derby.iapi.jdbc.AutoloadedDriver").save()
    except Exception as e:  # noqa: BLE001
        pytest.skip(f"no database to read from: {str(e)[:80]}")
    linked = dml.linked_table(spark, url, "LINKED", "ID", 0, 100, 4, driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    assert linked.count() == 100 and linked.rdd.getNumPartitions() == 4


def test_numbers_along_an_order(spark):
    rows = spark.range(500).select((F.col("id") * 7 % 500).alias("x"))
    got = row_numbers(rows, [F.desc("x")]).collect()
    assert sorted((-r.x, r.number) for r in got) == [(-x, 500 - x) for x in range(499, -1, -1)]
    assert row_numbers(rows.limit(0), [F.asc("x")]).count() == 0


def test_rate_tables_are_checked(spark):
    slabs = spark.range(b.MOST_SLABS + 1).select(F.col("id").alias("lo"), F.col("id").alias("hi"), F.lit(1).alias("rate"))
    with pytest.raises(ValueError):
        b.range_lookup(spark.range(3).select(F.col("id").alias("x")), "x", slabs)


def test_truth_files(spark, tmp_path):
    (tmp_path / "o.json").write_text(json.dumps({"object_id": "O", "rules": [{"id": "A", "subject": "bal", "source_lines": [3, 4]}, {"id": "B", "subject": "x", "source_lines": []}]}))
    truth = ru.truth_files(spark, str(tmp_path))
    found = spark.createDataFrame([("O", "BR-001", "Validate Bal", 5), ("O", "BR-002", "Other", 40)], "object_id string, rule_id string, name string, line int")
    r = ru.micro_averaged(ru.evaluate(truth, found)).first()
    assert (r.matched, r.extracted, r.truth, r.precision, r.recall) == (1, 2, 2, 0.5, 0.5)


def test_signals_and_ids(spark, tmp_path):
    text = "alter table t add (x number);\nbegin forall i in 1 .. 3 insert into t values (i); end;"
    files = spark.createDataFrame([("a.sql", text), ("b.sql", "")], "file string, text string")
    rows = {r.file: r for r in inv.route_ddl(inv.inventory(files)).collect()}
    assert rows["a.sql"].content_hints["has_forall"] and rows["a.sql"].is_ddl and not rows["b.sql"].content_hints
    assert rows["b.sql"].line_counts.total_lines == 0 and len(inv.SIGNALS) == 25 and set(inv.SIGNALS) == set(inv._NEEDED)
    folder = tmp_path / "x"
    (folder / "sub").mkdir(parents=True)
    (folder / "sub" / "none.sql").write_bytes(b"")
    (folder / "some.sql").write_text("x")
    assert sorted((r.file, r.size_bytes) for r in inv.discover(spark, str(folder)).collect()) == [("some.sql", 1), ("sub/none.sql", 0)]


@pytest.mark.parametrize("name, wanted", [("scan_partition_filter", "PushedFilters: [IsNotNull(lang), EqualTo(lang,fr)]"), ("group_having", "ReadSchema: struct<l_quantity"), ("partitioned_table", "PartitionFilters: [isnotnull(lang")])
def test_scans_are_pruned(spark, name, wanted):
    plan = registry.queries()[name](spark, os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert wanted in plan
