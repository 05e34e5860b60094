"""Triggers, versions, refreshed views and partitioned layouts over the driver's tables, each with the SQL that it is held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.oracle import money
from ..plans.cut import fresh
from . import dml

_M = "DECIMAL(18,2)"
QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _read(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _accounts(spark, sf_dir: str, **options) -> dml.ChangingTable:
    table = dml.ChangingTable(spark, fresh(spark, "tables"), "accounts", **options)
    table.write(_read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("k"), money(F.col("c_acctbal")).alias("balance"), F.col("c_mktsegment").alias("segment")))
    return table


_A = f"SELECT CAST(c_custkey AS BIGINT) AS k, CAST(c_acctbal AS {_M}) AS balance, c_mktsegment AS segment FROM customer"
_S = f"SELECT CAST(s_suppkey * 3 AS BIGINT) AS k, CAST(s_acctbal AS {_M}) AS amount FROM supplier"
#: What the compound trigger makes of a merge of _S: a fee of one on accounts that fall below zero, new accounts in upper case.
_MERGED = f"""SELECT coalesce(t.k, s.k) AS k, CASE WHEN s.k IS NULL THEN 'NONE' WHEN t.k IS NULL THEN 'INSERT' WHEN t.balance < -900 THEN 'DELETE' ELSE 'UPDATE' END AS op, t.balance AS old_balance,
CAST(CASE WHEN s.k IS NULL THEN t.balance WHEN t.k IS NULL THEN s.amount ELSE t.balance + s.amount - CASE WHEN t.balance + s.amount < 0 THEN 1 ELSE 0 END END AS {_M}) AS balance,
CASE WHEN t.k IS NULL THEN 'NEW' ELSE t.segment END AS segment FROM ({_A}) t FULL JOIN ({_S}) s ON t.k = s.k"""


def _merged(spark, sf_dir: str):
    """A merge under a compound trigger: before each row a fee and upper case, after each row an audit, after the statement a total by the shared state."""
    table = _accounts(spark, sf_dir)
    audit, totals = (dml.ChangingTable(spark, table.root, n) for n in ("audit", "totals"))
    audit.write(spark.createDataFrame([], f"k long, op string, old_balance {_M}, new_balance {_M}, label string"))
    totals.write(spark.createDataFrame([], f"label string, op string, n long, total {_M}"))
    poor = lambda new: F.when(new("balance") < 0, 1).otherwise(0)
    inserting = F.col("op") == dml.INSERT

    def begin(state: dict) -> None:
        state["label"] = "merge of suppliers"

    def end(state: dict, changes: DataFrame) -> None:
        moved = F.coalesce(F.col("new.balance"), F.lit(0)) - F.coalesce(F.col("old.balance"), F.lit(0))
        totals.insert(changes.groupBy("op").agg(F.count(F.lit(1)).alias("n"), F.sum(moved).cast(_M).alias("total")).withColumn("label", F.lit(state["label"])))

    trigger = dml.Trigger(
        before_statement=begin,
        before_row=lambda old, new, state: {"balance": new("balance") - F.when(inserting, 0).otherwise(poor(new)), "segment": F.when(inserting, F.upper(new("segment"))).otherwise(new("segment"))},
        check=lambda old, new, state: [(new("k") < 0, "no account below zero")],
        after_row=lambda old, new, state: {"k": F.coalesce(new("k"), old("k")), "op": F.col("op"), "old_balance": old("balance"), "new_balance": new("balance"), "label": F.lit(state["label"])},
        into=audit,
        after_statement=end,
    )
    table.triggers.append(trigger)
    source = _read(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 3).cast("long").alias("k"), money(F.col("s_acctbal")).alias("amount"))
    table.merge(source, ["k"], {"balance": F.col("t.balance") + F.col("s.amount")}, {"k": F.col("s.k"), "balance": F.col("s.amount"), "segment": F.lit("new")}, F.col("t.balance") < -900)
    return table, audit, totals


@_query(f"SELECT k, balance, segment FROM ({_MERGED}) WHERE op <> 'DELETE'")
def trigger_before_row(spark, sf_dir):
    return _merged(spark, sf_dir)[0].read()


@_query(f"SELECT k, op, old_balance, CASE WHEN op <> 'DELETE' THEN balance END AS new_balance, 'merge of suppliers' AS label FROM ({_MERGED}) WHERE op <> 'NONE'")
def trigger_after_row(spark, sf_dir):
    return _merged(spark, sf_dir)[1].read()


@_query(f"""SELECT 'merge of suppliers' AS label, op, count(*) AS n, CAST(sum(CASE WHEN op = 'DELETE' THEN 0 ELSE balance END - coalesce(old_balance, 0)) AS {_M}) AS total FROM ({_MERGED}) WHERE op <> 'NONE' GROUP BY op""")
def trigger_compound(spark, sf_dir):
    return _merged(spark, sf_dir)[2].read().select("label", "op", "n", "total")


@_query(f"""SELECT 1 AS step, 'UPDATE' AS op, k, CAST(balance + 100 AS {_M}) AS balance FROM ({_A}) WHERE segment = 'BUILDING' UNION ALL SELECT 2, 'DELETE', k, CAST(balance + CASE WHEN segment = 'BUILDING' THEN 100 ELSE 0 END AS {_M})
FROM ({_A}) WHERE balance + CASE WHEN segment = 'BUILDING' THEN 100 ELSE 0 END < 0 UNION ALL SELECT 3, 'INSERT', CAST(s_suppkey + 1000000 AS BIGINT), CAST(s_acctbal AS {_M}) FROM supplier""")
def versions_between(spark, sf_dir):
    """Every change of a row between the first and the last version, by the statement that made it."""
    table = _accounts(spark, sf_dir, layout=dml.by_list("segment"))
    first = table.history()[0]["run_version"]
    table.update({"balance": F.col("balance") + 100}, F.col("segment") == "BUILDING")
    table.delete(F.col("balance") < 0)
    last = table.insert(_read(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 1000000).alias("k"), money(F.col("s_acctbal")).alias("balance"), F.lit("NONE").alias("segment")))
    number = F.array_position(F.lit([v["run_version"] for v in table.history()]), F.col("version")).cast("int") - 1
    return table.versions_between(first, last, ["k"]).select(number.alias("step"), "op", "k", "balance")


@_query("""SELECT c_nationkey, CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN c_nationkey = 3 THEN CAST(c_acctbal AS DECIMAL(18,2)) * 2 ELSE CAST(c_acctbal AS DECIMAL(18,2)) END) AS DECIMAL(28,2)) AS total
FROM customer WHERE NOT (c_nationkey = 5 AND c_acctbal < 0) GROUP BY c_nationkey UNION ALL SELECT 99, CAST(count(*) AS BIGINT), CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DECIMAL(28,2)) FROM supplier""")
def materialized_view(spark, sf_dir):
    """A grouped view after an update, a delete and an insert of its table, refreshed by the groups that these changed."""
    base = dml.ChangingTable(spark, fresh(spark, "tables"), "customers", dml.by_hash(["c_nationkey"], 8))
    base.write(_read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("k"), F.col("c_nationkey").cast("int").alias("c_nationkey"), money(F.col("c_acctbal")).alias("balance")))
    view = dml.GroupedView(base, ["k"], ["c_nationkey"], [F.count(F.lit(1)).alias("n"), F.sum("balance").cast("decimal(28,2)").alias("total")], dml.ChangingTable(spark, base.root, "by_nation", dml.by_hash(["c_nationkey"], 8)))
    view.refresh()
    base.update({"balance": F.col("balance") * 2}, F.col("c_nationkey") == 3)
    base.delete((F.col("c_nationkey") == 5) & (F.col("balance") < 0))
    base.insert(_read(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 1000000).alias("k"), F.lit(99).alias("c_nationkey"), money(F.col("s_acctbal")).alias("balance")))
    view.refresh()
    return view.table.read()


def _by_month(spark, sf_dir: str) -> dml.ChangingTable:
    table = dml.ChangingTable(spark, fresh(spark, "tables"), "orders", dml.composite(dml.by_range("day", interval="year"), dml.by_hash(["k"], 2)))
    table.write(_read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("long").alias("k"), F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderstatus").alias("status"), money(F.col("o_totalprice")).alias("price")))
    return table


@_query("""SELECT CAST(o_orderkey AS BIGINT) AS k, CASE WHEN year(o_orderdate) = 1995 AND o_orderkey % 2 = 0 THEN 'X' ELSE o_orderstatus END AS status FROM orders WHERE NOT (year(o_orderdate) = 1996 AND o_totalprice < 50000)""")
def partitioned_changes(spark, sf_dir):
    """Ranges of a year, hashed in two: an update and a delete that rewrite the parts of one year each."""
    table = _by_month(spark, sf_dir)
    table.update({"status": F.lit("X")}, (F.year("day") == 1995) & (F.col("k") % 2 == 0))
    table.delete((F.year("day") == 1996) & (F.col("price") < 50000))
    return table.read().select("k", "status")


@_query("SELECT c_mktsegment AS segment, CAST(count(*) AS BIGINT) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def bucketed_join(spark, sf_dir):
    """Two tables of equal hash buckets."""
    return joined_buckets(spark, sf_dir).groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


def joined_buckets(spark, sf_dir: str) -> DataFrame:
    name = fresh(spark, "b").rsplit("-", 1)[1][:12]
    a = dml.bucketed(_read(spark, sf_dir, "orders").select(F.col("o_custkey").cast("long").alias("k"), "o_orderkey"), f"ql_orders_{name}", ["k"], 8, fresh(spark, "buckets"))
    b = dml.bucketed(_read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("k"), F.col("c_mktsegment").alias("segment")), f"ql_customers_{name}", ["k"], 8, fresh(spark, "buckets"))
    return a.hint("merge").join(b, "k")


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
