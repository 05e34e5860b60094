"""The routines over the driver's tables, each with the SQL that it is held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from . import banking as b
from ..functions.oracle import dec_round, money

_M = "DECIMAL(18,2)"
QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_RATE = "CASE WHEN balance < 100000 THEN 3.0 WHEN balance < 1000000 THEN 3.5 WHEN balance < 10000000 THEN 4.0 ELSE 4.5 END"


@_query(f"""SELECT account_number, CAST(balance AS {_M}) AS balance, CAST(rate AS DECIMAL(6,3)) AS rate, CAST(interest AS {_M}) AS interest, 'Monthly interest @ ' || CASE rate WHEN 3.0 THEN '3' WHEN 4.0 THEN '4' ELSE CAST(CAST(rate AS DECIMAL(3,1)) AS VARCHAR) END || '%' AS narration
FROM (SELECT *, round(CAST(balance * 1000 * CAST(rate * 10 AS INT) * 30 AS DECIMAL(38,2)) / 365000000, 2) AS interest FROM (SELECT c_custkey AS account_number, balance, CAST({_RATE} AS DECIMAL(6,3)) AS rate FROM (SELECT c_custkey, CAST(c_acctbal * 100 AS {_M}) AS balance, c_mktsegment FROM customer) c WHERE c_mktsegment LIKE 'A%')) WHERE interest > 0""")
def tiered_interest(spark, sf_dir):
    accounts = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("account_number"), money(F.col("c_acctbal") * 100).alias("balance"), F.lit("ACTIVE").alias("account_status"), F.when(F.col("c_mktsegment").like("A%"), "SAVINGS_REGULAR").otherwise("CURRENT_REGULAR").alias("account_type"))
    return b.monthly_interest(accounts, F.to_date(F.lit("2026-06-30")))


@_query(f"""SELECT c_custkey, CASE WHEN principal < 0 THEN -20001 END AS error, CASE WHEN principal >= 0 THEN CAST(round(CAST(principal * 15 * days AS DECIMAL(38,2)) / (200 * year), 2) AS {_M}) END AS interest
FROM (SELECT c_custkey, CAST(c_acctbal AS {_M}) AS principal, c_nationkey * 10 AS days, CASE WHEN c_mktsegment = 'BUILDING' THEN 360 ELSE 365 END AS year FROM customer)""")
def simple_interest(spark, sf_dir):
    c = _read(spark, sf_dir, "customer")
    interest, error = b.simple_interest(money(F.col("c_acctbal")), F.lit("7.5").cast("decimal(8,4)"), F.col("c_nationkey") * 10, F.when(F.col("c_mktsegment") == "BUILDING", "360").otherwise("365"))
    return c.select("c_custkey", error.alias("error"), interest.alias("interest"))


@_query("""SELECT c_custkey, CASE WHEN status = 'ACTIVE' AND days > 365 THEN 'DORMANT' WHEN status = 'DORMANT' AND days <= 365 THEN 'ACTIVE' ELSE status END AS status,
CASE WHEN status = 'ACTIVE' AND days > 365 THEN 'MARKED_DORMANT' WHEN status = 'DORMANT' AND days <= 365 THEN 'REACTIVATED' ELSE 'NO_STATUS_CHANGE_REQUIRED' END AS outcome
FROM (SELECT c_custkey, CASE WHEN c_nationkey % 3 = 0 THEN 'DORMANT' ELSE 'ACTIVE' END AS status, coalesce(date_diff('second', last, TIMESTAMP '1998-08-01 12:00:00') / 86400.0, 9999) AS days
      FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey)""")
def dormancy_transition(spark, sf_dir):
    last = _read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("last"))
    rows = _read(spark, sf_dir, "customer").join(last, "c_custkey", "left").withColumn("status", F.when(F.col("c_nationkey") % 3 == 0, "DORMANT").otherwise("ACTIVE"))
    new, outcome = b.dormancy(F.col("status"), F.col("last"), F.lit("1998-08-01 12:00:00").cast("timestamp"))
    return rows.select("c_custkey", new.alias("status"), outcome.alias("outcome"))


@_query(f"""SELECT c_custkey, CAST(CASE WHEN bal < need THEN need - bal ELSE 0 END AS {_M}) AS shortfall, CAST(CASE WHEN bal < need THEN least(500, greatest(50, round(CAST((need - bal) * 5 AS DECIMAL(38,2)) / 100, 2))) ELSE 0 END AS {_M}) AS penalty, CASE WHEN bal < need THEN 'BELOW_MINIMUM_BALANCE' ELSE 'BALANCE_OK' END AS outcome
FROM (SELECT c_custkey, CAST(c_acctbal AS {_M}) AS bal, CASE c_mktsegment WHEN 'BUILDING' THEN 10000 WHEN 'MACHINERY' THEN 5000 ELSE 1000 END AS need FROM customer)""")
def min_balance_penalty(spark, sf_dir):
    kind = F.when(F.col("c_mktsegment") == "BUILDING", "SAVINGS_PREMIUM").when(F.col("c_mktsegment") == "MACHINERY", "CURRENT_REGULAR").otherwise("OTHER")
    shortfall, penalty, outcome = b.minimum_balance_check(money(F.col("c_acctbal")), kind)
    return _read(spark, sf_dir, "customer").select("c_custkey", shortfall.alias("shortfall"), penalty.alias("penalty"), outcome.alias("outcome"))


@_query(f"""SELECT event_id, CAST(coalesce(sum(CAST(value AS {_M})) OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS {_M}) AS sent_today FROM events""")
def daily_outward_limit(spark, sf_dir):
    rows = _read(spark, sf_dir, "events").withColumn("amount", money(F.col("value")))
    return b.running_daily_total(rows, "user_id", "ts", "amount", "event_id").select("event_id", money(F.col("sent_today")).alias("sent_today"))


@_query("""SELECT o_orderkey, CASE WHEN amount <= 0 THEN 'INVALID_AMOUNT' WHEN o_custkey = target THEN 'SAME_ACCOUNT' WHEN s.st IS NULL THEN 'SOURCE_NOT_FOUND' WHEN s.st <> 'ACTIVE' THEN 'SOURCE_NOT_ACTIVE' WHEN t.st IS NULL THEN 'TARGET_NOT_FOUND' WHEN t.st <> 'ACTIVE' THEN 'TARGET_NOT_ACTIVE' WHEN s.bal < amount THEN 'INSUFFICIENT_BALANCE' WHEN sent + amount > s.lim THEN 'DAILY_LIMIT_EXCEEDED' ELSE 'SUCCESS' END AS outcome
FROM (SELECT *, coalesce(sum(amount) OVER (PARTITION BY o_custkey, date_trunc('quarter', o_orderdate) ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sent FROM (SELECT o_orderkey, o_custkey, o_orderdate, CAST((o_orderkey * 7) % 2000 AS BIGINT) AS target, CAST(o_totalprice / 100 - 20 AS DECIMAL(18,2)) AS amount FROM orders)) o
LEFT JOIN (SELECT c_custkey, CASE WHEN c_nationkey % 5 = 0 THEN 'CLOSED' ELSE 'ACTIVE' END AS st, CAST(c_acctbal AS DECIMAL(18,2)) AS bal, CASE WHEN c_nationkey % 4 = 0 THEN NULL ELSE 2000 END AS lim FROM customer) s ON s.c_custkey = o_custkey
LEFT JOIN (SELECT c_custkey, CASE WHEN c_nationkey % 5 = 0 THEN 'CLOSED' ELSE 'ACTIVE' END AS st FROM customer) t ON t.c_custkey = target""")
def transfer_validation(spark, sf_dir):
    accounts = _read(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_nationkey") % 5 == 0, "CLOSED").otherwise("ACTIVE").alias("st"), money(F.col("c_acctbal")).alias("bal"), F.when(F.col("c_nationkey") % 4 != 0, 2000).alias("lim"))
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", F.date_trunc("quarter", "o_orderdate").alias("day"), (F.col("o_orderkey") * 7 % 2000).alias("target"), money(F.col("o_totalprice") / 100 - 20).alias("amount"))
    # The quarter stands for the routine's day, as the tables have few orders a day.
    o = o.withColumn("sent_today", F.coalesce(F.sum("amount").over(Window.partitionBy("o_custkey", "day").orderBy("o_orderdate", "o_orderkey").rowsBetween(Window.unboundedPreceding, -1)), money(F.lit(0))))
    o = o.join(accounts.withColumnsRenamed({"c_custkey": "o_custkey", "st": "source_st"}), "o_custkey", "left").join(accounts.select(F.col("c_custkey").alias("target"), F.col("st").alias("target_st")), "target", "left")
    return o.select("o_orderkey", b.transfer_outcome(F.col("amount"), F.col("o_custkey"), F.col("target"), F.col("source_st"), F.col("target_st"), F.col("bal"), F.col("lim"), F.col("sent_today")).alias("outcome"))


@_query(f"""WITH legs AS (SELECT o_orderkey, o_custkey AS account, -CAST(o_totalprice AS {_M}) AS amount, 'TRANSFER_OUT' AS txn_type FROM orders UNION ALL SELECT o_orderkey, o_custkey + 1, CAST(o_totalprice AS {_M}), 'TRANSFER_IN' FROM orders)
SELECT o_orderkey, account, CAST(amount AS {_M}) AS amount, txn_type, CAST(sum(amount) OVER (PARTITION BY account ORDER BY o_orderkey, txn_type ROWS UNBOUNDED PRECEDING) AS {_M}) AS running_balance FROM legs""")
def double_entry_ledger(spark, sf_dir):
    o = _read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("s"), (F.col("o_custkey") + 1).alias("t"), money(F.col("o_totalprice")).alias("amt"))
    return b.double_entry(o, "s", "t", "amt", "o_orderkey").select("o_orderkey", "account", money(F.col("amount")).alias("amount"), "txn_type", money(F.col("running_balance")).alias("running_balance"))


@_query("SELECT CAST(event_id AS VARCHAR) AS entity_key, 'value can''t be used' AS error_message FROM events WHERE try_cast(substr(event_type, 1, 1) || CAST(user_id AS VARCHAR) AS INT) IS NULL")
def failure_isolation_split(spark, sf_dir):
    rows = _read(spark, sf_dir, "events")
    return b.split_failures(rows, F.expr("try_cast(concat(substr(event_type, 1, 1), user_id) AS INT)"), "event_id")[1]


@_query("SELECT c_custkey, r.rate FROM customer LEFT JOIN (VALUES (-1000000.0, 0.0, 1), (0.0, 2500.0, 2), (2500.01, 7500.0, 3), (7500.01, NULL, 4)) r(lo, hi, rate) ON c_acctbal >= lo AND (hi IS NULL OR c_acctbal <= hi)")
def slab_range_join(spark, sf_dir):
    slabs = spark.sql("SELECT CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi, rate FROM VALUES (-1000000.0, 0.0, 1), (0.0, 2500.0, 2), (2500.01, 7500.0, 3), (7500.01, NULL, 4) t(lo, hi, rate)")
    return b.range_lookup(_read(spark, sf_dir, "customer"), "c_acctbal", slabs).select("c_custkey", "rate")


@_query("SELECT event_id, CAST(count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 10 MINUTE PRECEDING AND CURRENT ROW) AS BIGINT) AS in_ten_minutes, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 10 MINUTE PRECEDING AND CURRENT ROW) >= 6 AS exceeds FROM events")
def velocity_window(spark, sf_dir):
    n = F.expr("count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 10 MINUTES PRECEDING AND CURRENT ROW)")
    return _read(spark, sf_dir, "events").select("event_id", n.alias("in_ten_minutes"), (n >= b.VELOCITY_LIMIT).alias("exceeds"))


@_query("SELECT event_id, before, before <> event_type AND ts < since + INTERVAL 40 MINUTE AS impossible FROM (SELECT event_id, event_type, ts, lag(event_type) OVER w AS before, lag(ts) OVER w AS since FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))")
def impossible_change(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = _read(spark, sf_dir, "events").select("event_id", "event_type", "ts", F.lag("event_type").over(w).alias("before"), F.lag("ts").over(w).alias("at"))
    return rows.select("event_id", "before", ((F.col("before") != F.col("event_type")) & (F.col("ts") < F.col("at") + F.expr("INTERVAL 40 MINUTES"))).alias("impossible"))


@_query(f"SELECT event_id, coalesce(v * n >= 10 * s, FALSE) AS anomaly FROM (SELECT event_id, CAST(value AS {_M}) AS v, sum(CAST(value AS {_M})) OVER w AS s, count(*) OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) WHERE n >= 0")
def amount_anomaly(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    v = money(F.col("value"))
    return _read(spark, sf_dir, "events").select("event_id", F.coalesce(v * F.count(F.lit(1)).over(w) >= 10 * F.sum(v).over(w), F.lit(False)).alias("anomaly"))


@_query("SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber, l_quantity, row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber) AS r FROM lineitem) WHERE r = 1 AND l_quantity > 40")
def first_time_pair(spark, sf_dir):
    w = Window.partitionBy("l_suppkey", "l_partkey").orderBy("l_shipdate", "l_orderkey", "l_linenumber")
    return _read(spark, sf_dir, "lineitem").withColumn("r", F.row_number().over(w)).filter("r = 1 and l_quantity > 40").select("l_orderkey", "l_linenumber")


@_query("SELECT event_id FROM events WHERE extract(HOUR FROM ts) < 5 AND value > 50")
def odd_hour(spark, sf_dir):
    return _read(spark, sf_dir, "events").filter((F.hour("ts") < 5) & (F.col("value") > 50)).select("event_id")


@_query("""WITH d AS (SELECT o_orderkey, o_custkey, o_orderdate, CAST(o_orderkey % 1500 - 100 AS INT) AS dpd, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) END AS restructured FROM orders),
k AS (SELECT *, CASE WHEN dpd <= 0 AND CAST(restructured + INTERVAL 12 MONTH AS DATE) >= DATE '1996-06-30' THEN 2 WHEN dpd <= 0 THEN 1 WHEN dpd <= 90 THEN 2 WHEN dpd <= 365 THEN 3 WHEN dpd <= 1095 THEN 4 ELSE 5 END AS b FROM d),
p AS (SELECT *, lag(b) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before FROM k)
SELECT o_orderkey, ['STANDARD', 'SPECIAL_MENTION', 'SUBSTANDARD', 'DOUBTFUL', 'LOSS'][b] AS bucket, CASE WHEN before IS NULL THEN 'NEW' WHEN before = b THEN 'UNCHANGED' WHEN b < before THEN 'UPGRADED' ELSE 'DOWNGRADED' END AS movement FROM p""")
def bucket_and_movement(spark, sf_dir):
    rows = _read(spark, sf_dir, "orders").withColumn("bucket", b.npa_bucket(F.col("o_orderkey") % 1500 - 100, F.when(F.col("o_orderkey") % 2 == 0, F.to_date("o_orderdate")), F.to_date(F.lit("1996-06-30"))))
    before = F.lag("bucket").over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    return rows.withColumn("before", before).select("o_orderkey", "bucket", b.movement(F.col("bucket"), F.col("before")).alias("movement"))


@_query(f"SELECT o_custkey, o_orderkey, CAST(sum(CAST(o_totalprice AS {_M})) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS {_M}) AS running_balance FROM orders")
def account_statement(spark, sf_dir):
    rows = _read(spark, sf_dir, "orders").withColumn("amount", money(F.col("o_totalprice")))
    return b.statement(rows, "o_custkey", ["o_orderdate", "o_orderkey"], "amount").select("o_custkey", "o_orderkey", money(F.col("running_balance")).alias("running_balance"))


_SCHEDULE = """WITH RECURSIVE l AS (SELECT c_custkey AS loan, CAST(100000 * (c_custkey % 5 + 1) AS DOUBLE) AS p, 6.0 + c_custkey % 4 AS rate, 12 * (c_custkey % 3 + 1) AS m FROM customer),
resets AS (SELECT loan, due, 7.5 + due / 12.0 AS rate FROM l, (VALUES (7), (20)) t(due) WHERE {resets}),
s AS (SELECT loan, m, 1 AS i, p AS opening, rate / 1200 AS r, p * (rate / 1200) * pow(1 + rate / 1200, m) / (pow(1 + rate / 1200, m) - 1) AS emi FROM l
UNION ALL SELECT loan, m, i, opening, r, CASE WHEN changed THEN opening * r * pow(1 + r, m - i + 1) / (pow(1 + r, m - i + 1) - 1) ELSE emi END FROM
 (SELECT s.loan, s.m, s.i + 1 AS i, s.opening * (1 + s.r) - s.emi AS opening, coalesce(x.rate / 1200, s.r) AS r, s.emi, x.rate IS NOT NULL AS changed FROM s LEFT JOIN resets x ON x.loan = s.loan AND x.due = s.i + 1 WHERE s.i < s.m))
SELECT loan, i AS installment_no, CAST(round(opening, 2) AS DECIMAL(18,2)) AS opening_balance, CAST(round(emi, 2) AS DECIMAL(18,2)) AS emi_amount, CAST(round(opening * r, 2) AS DECIMAL(18,2)) AS interest_component, CAST(round(emi - opening * r, 2) AS DECIMAL(18,2)) AS principal_component, CAST(round(opening * (1 + r) - emi, 2) AS DECIMAL(18,2)) AS closing_balance FROM s"""


def _loans(spark, sf_dir):
    k = F.col("c_custkey")
    return _read(spark, sf_dir, "customer").select(k.alias("loan"), (F.lit(100000.0) * (k % 5 + 1)).alias("p"), (F.lit(6.0) + k % 4).alias("rate"), (12 * (k % 3 + 1)).alias("m"))


def _amounts(rows: DataFrame) -> DataFrame:
    return rows.select("loan", F.col("installment_no").cast("int").alias("installment_no"), *[F.col(c).cast("decimal(18,2)").alias(c) for c in ("opening_balance", "emi_amount", "interest_component", "principal_component", "closing_balance")])


@_query(_SCHEDULE.format(resets="FALSE"))
def amortization_schedule(spark, sf_dir):
    return _amounts(b.amortization_with_resets(_loans(spark, sf_dir), "loan", "p", "rate", "m", spark.createDataFrame([], "loan long, effective_installment_no int, revised_annual_rate double")))


@_query(_SCHEDULE.format(resets="(loan + due) % 2 = 0"))
def amortization_resets(spark, sf_dir):
    loans = _loans(spark, sf_dir)
    at = F.explode(F.array(F.lit(7), F.lit(20))).alias("effective_installment_no")
    resets = loans.select("loan", at).filter((F.col("loan") + F.col("effective_installment_no")) % 2 == 0).withColumn("revised_annual_rate", 7.5 + F.col("effective_installment_no") / 12.0)
    return _amounts(b.amortization_with_resets(loans, "loan", "p", "rate", "m", resets))


@_query("""SELECT l_orderkey, l_linenumber, in_force FROM lineitem ASOF LEFT JOIN (SELECT o_custkey, o_orderdate, max(o_orderkey) AS in_force FROM orders GROUP BY o_custkey, o_orderdate) r ON l_suppkey = r.o_custkey AND l_shipdate >= r.o_orderdate""")
def as_of_rate(spark, sf_dir):
    rows = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("k"), "l_shipdate")
    rates = _read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k"), "o_orderdate").agg(F.max("o_orderkey").alias("in_force"))
    return b.rate_in_force(rows, ["k"], "l_shipdate", rates, "o_orderdate", "in_force").select("l_orderkey", "l_linenumber", "in_force")


@_query("""WITH r(product_code, lo, hi, rate, since) AS (VALUES ('BUILDING', -100000, 5000, 2.5, DATE '2026-01-01'), ('BUILDING', 5000.01, NULL, 3.25, DATE '2026-01-01'), ('BUILDING', 5000.01, NULL, 3.5, DATE '2026-01-15'), ('MACHINERY', -100000, NULL, 4.125, DATE '2026-01-10')),
d AS (SELECT CAST(generate_series AS DATE) AS day FROM generate_series(DATE '2026-01-01', DATE '2026-01-31', INTERVAL 1 DAY) WHERE date_part('dow', generate_series) NOT IN (0, 6) AND day NOT IN (DATE '2026-01-01', DATE '2026-01-26')),
x AS (SELECT c_custkey AS account_number, day AS accrual_date, CAST(c_acctbal AS DECIMAL(18,2)) AS balance, arg_max(rate, since) AS rate FROM customer JOIN d ON TRUE JOIN r ON c_mktsegment = product_code AND CAST(c_acctbal AS DECIMAL(18,2)) >= lo AND (hi IS NULL OR CAST(c_acctbal AS DECIMAL(18,2)) <= hi) AND since <= day GROUP BY ALL)
SELECT account_number, accrual_date, CAST(sign(balance) * floor(abs(balance) * CAST(rate * 1000 AS BIGINT) * 20 / 73000 + 0.5) / 10000 AS DECIMAL(18,4)) AS accrued_amount, CAST(rate AS DECIMAL(6,3)) AS applied_rate FROM x""")
def holiday_accrual(spark, sf_dir):
    accounts = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("account_number"), F.col("c_mktsegment").alias("product_code"), money(F.col("c_acctbal")).alias("balance"))
    rates = spark.sql("SELECT product_code, CAST(lo AS DECIMAL(18,2)) AS min_balance, CAST(hi AS DECIMAL(18,2)) AS max_balance, CAST(rate AS DECIMAL(6,3)) AS annual_rate, CAST(since AS DATE) AS effective_date FROM VALUES ('BUILDING', -100000, 5000, 2.5, '2026-01-01'), ('BUILDING', 5000.01, NULL, 3.25, '2026-01-01'), ('BUILDING', 5000.01, NULL, 3.5, '2026-01-15'), ('MACHINERY', -100000, NULL, 4.125, '2026-01-10') t(product_code, lo, hi, rate, since)")
    days = spark.sql("SELECT explode(sequence(DATE '2026-01-01', DATE '2026-01-31')) AS day")
    holidays = days.filter("dayofweek(day) IN (1, 7) OR day IN (DATE '2026-01-01', DATE '2026-01-26')").select(F.col("day").alias("holiday_date"))
    return b.accrue(accounts, rates, days, holidays).select("account_number", "accrual_date", F.col("accrued_amount").cast("decimal(18,4)").alias("accrued_amount"), "applied_rate")


_SHARES = {"STANDARD": "0.40", "SPECIAL_MENTION": "5.00", "SUBSTANDARD": "15.00", "DOUBTFUL": "40.00", "LOSS": "100.00"}


@_query("""SELECT CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end_date, count(*) AS total_accounts, CAST(CAST(sum((CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) * [40, 500, 1500, 4000, 10000][o_orderkey % 5 + 1] + 5000) // 10000) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(20,2)) AS total_provisioning_amount FROM orders GROUP BY 1""")
def npa_provisioning(spark, sf_dir):
    kind = F.element_at(F.lit(list(b.BUCKETS)), (F.col("o_orderkey") % 5 + 1).cast("int"))
    loans = _read(spark, sf_dir, "orders").select(kind.alias("classification"), F.to_date("o_orderdate").alias("classification_date"), money(F.col("o_totalprice")).alias("outstanding_principal"))
    return b.provisioning(loans, _SHARES)[1]


@_query("SELECT l_orderkey, l_linenumber, c_nationkey <> s_nationkey AS mismatch FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey")
def geo_mismatch(spark, sf_dir):
    rows = _read(spark, sf_dir, "lineitem").join(_read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(_read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(_read(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.select("l_orderkey", "l_linenumber", b.geo_mismatch(F.col("c_nationkey"), F.col("s_nationkey")).alias("mismatch"))


@_query("""SELECT c_custkey, CAST(CASE WHEN x.amount IS NULL THEN bal ELSE coalesce(bal + x.amount, 0) END AS DECIMAL(20,2)) AS balance FROM (SELECT c_custkey, CASE WHEN c_nationkey % 7 <> 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) END AS bal FROM customer)
LEFT JOIN (SELECT o_custkey, sum(CASE WHEN o_orderstatus = 'F' THEN -CAST(o_totalprice AS DECIMAL(18,2)) ELSE CAST(o_totalprice AS DECIMAL(18,2)) END) AS amount FROM orders GROUP BY o_custkey) x ON o_custkey = c_custkey""")
def account_package(spark, sf_dir):
    accounts = _read(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_nationkey") % 7 != 0, money(F.col("c_acctbal"))).alias("balance"))
    amount = money(F.col("o_totalprice"))
    changes = _read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderstatus") == "F", -amount).otherwise(amount).alias("amount"))
    return b.change_balances(accounts, changes, "c_custkey").select("c_custkey", "balance")


_CLAIMS = "SELECT o_orderkey AS claim_id, o_orderkey * 3 % 2000 AS contract_id, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders"


def _claims(spark, sf_dir):
    o = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("claim_id"), (F.col("o_orderkey") * 3 % 2000).alias("contract_id"), money(F.col("o_totalprice")).alias("amount"))
    return b.register_claims(o, _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("contract_id"), F.when(F.col("c_nationkey") % 2 == 0, "ACTIVE").otherwise("LAPSED").alias("contract_status")), 500)


@_query(f"SELECT claim_id, CASE WHEN c_custkey IS NULL THEN 'CONTRACT_NOT_FOUND' WHEN c_nationkey % 2 <> 0 THEN 'CONTRACT_NOT_ACTIVE' ELSE 'CLAIM_REGISTERED' END AS outcome FROM ({_CLAIMS}) LEFT JOIN customer ON c_custkey = contract_id")
def claim_outcomes(spark, sf_dir):
    return _claims(spark, sf_dir)[0]


@_query(f"SELECT 499 + row_number() OVER (ORDER BY claim_id) AS registered_id, claim_id, contract_id, amount, 'OPEN' AS claim_status FROM ({_CLAIMS}) JOIN customer ON c_custkey = contract_id AND c_nationkey % 2 = 0")
def claim_register(spark, sf_dir):
    return _claims(spark, sf_dir)[1]


@_query(f"""SELECT row_number() OVER (ORDER BY account_number) + 7000 AS txn_id, account_number, CAST(interest AS {_M}) AS txn_amount FROM (SELECT c_custkey AS account_number, round(CAST(balance * 1000 * CAST(rate * 10 AS INT) * 30 AS DECIMAL(38,2)) / 365000000, 2) AS interest
FROM (SELECT c_custkey, balance, CAST({_RATE} AS DECIMAL(6,3)) AS rate FROM (SELECT c_custkey, CAST(c_acctbal * 100 AS {_M}) AS balance FROM customer WHERE c_mktsegment LIKE 'A%'))) WHERE interest > 0""")
def interest_ledger(spark, sf_dir):
    day = F.to_date(F.lit("2026-06-30"))
    return b.apply_interest(tiered_interest(spark, sf_dir), day, 7001)[1].select("txn_id", "account_number", "txn_amount")


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
