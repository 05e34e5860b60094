"""Writing statements, functions and outside tables over the driver's tables, each with the SQL that it is held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import user
from ..functions.oracle import money
from ..plans.cut import fresh, row_numbers
from . import banking, dml

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


def _accounts(spark, sf_dir: str) -> dml.ChangingTable:
    table = dml.ChangingTable(spark, fresh(spark, "tables"), "accounts")
    table.write(_read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), money(F.col("c_acctbal")).alias("balance"), F.col("c_mktsegment").alias("segment")))
    return table


_A = f"SELECT c_custkey AS k, CAST(c_acctbal AS {_M}) AS balance, c_mktsegment AS segment FROM customer"


@_query(f"""SELECT coalesce(t.k, s.k) AS k, CAST(CASE WHEN t.k IS NULL THEN s.total WHEN s.k IS NULL THEN t.balance ELSE t.balance + s.total END AS {_M}) AS balance, CASE WHEN t.k IS NULL THEN 'NEW' ELSE t.segment END AS segment
FROM ({_A}) t FULL JOIN (SELECT o_custkey * 2 AS k, sum(CAST(o_totalprice AS {_M})) AS total, count(*) AS n FROM orders GROUP BY o_custkey) s ON t.k = s.k WHERE NOT coalesce(t.k IS NOT NULL AND s.n > 14, FALSE)""")
def dml_merge(spark, sf_dir):
    table = _accounts(spark, sf_dir)
    s = _read(spark, sf_dir, "orders").groupBy((F.col("o_custkey") * 2).alias("k")).agg(F.sum(money(F.col("o_totalprice"))).alias("total"), F.count(F.lit(1)).alias("n"))
    table.merge(s, ["k"], {"balance": F.col("t.balance") + F.col("s.total")}, {"k": F.col("s.k"), "balance": F.col("s.total"), "segment": F.lit("NEW")}, F.col("s.n") > 14)
    return table.read()


@_query(f"SELECT k, CAST(CASE WHEN segment = 'BUILDING' THEN balance + 100 ELSE balance END AS {_M}) AS balance, segment FROM ({_A})")
def dml_update(spark, sf_dir):
    table = _accounts(spark, sf_dir)
    table.update({"balance": F.col("balance") + 100}, F.col("segment") == "BUILDING")
    return table.read()


@_query(f"SELECT k, CAST(balance * 2 AS {_M}) AS balance FROM ({_A}) WHERE balance < 0")
def dml_returning(spark, sf_dir):
    return _accounts(spark, sf_dir).update({"balance": F.col("balance") * 2}, F.col("balance") < 0)[1].select("k", "balance")


@_query(f"SELECT * FROM ({_A}) WHERE NOT (segment = 'BUILDING' AND balance < 5000)")
def dml_delete(spark, sf_dir):
    table = _accounts(spark, sf_dir)
    table.delete((F.col("segment") == "BUILDING") & (F.col("balance") < 5000))
    return table.read()


@_query(f"SELECT * FROM ({_A}) UNION ALL SELECT s_suppkey + 1000000, CAST(s_acctbal AS {_M}), 'NONE' FROM supplier")
def dml_insert(spark, sf_dir):
    table = _accounts(spark, sf_dir)
    table.insert(_read(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 1000000).alias("k"), money(F.col("s_acctbal")).alias("balance")), {"segment": F.lit("NONE")})
    return table.read()


def _targets(spark, names: str):
    root = fresh(spark, "tables")
    made = [dml.ChangingTable(spark, root, n) for n in names.split()]
    for t in made:
        t.write(spark.createDataFrame([], "p_partkey long, p_size int, p_retailprice double"))
    return made


def _parts(spark, sf_dir):
    return _read(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("p_partkey"), F.col("p_size").cast("int").alias("p_size"), "p_retailprice")


@_query("SELECT 'cheap' AS target, CAST(p_partkey AS BIGINT) AS p_partkey FROM part WHERE p_retailprice < 1200 UNION ALL SELECT 'small', p_partkey FROM part WHERE p_size < 10")
def dml_insert_all(spark, sf_dir):
    cheap, small = _targets(spark, "cheap small")
    dml.insert_each(_parts(spark, sf_dir), [(cheap, F.col("p_retailprice") < 1200), (small, F.col("p_size") < 10)])
    return cheap.read().select(F.lit("cheap").alias("target"), "p_partkey").unionByName(small.read().select(F.lit("small").alias("target"), "p_partkey"))


@_query("SELECT CASE WHEN p_retailprice < 1200 THEN 'cheap' WHEN p_size < 10 THEN 'small' ELSE 'rest' END AS target, CAST(p_partkey AS BIGINT) AS p_partkey FROM part")
def dml_insert_first(spark, sf_dir):
    tables = _targets(spark, "cheap small rest")
    dml.insert_each(_parts(spark, sf_dir), list(zip(tables, [F.col("p_retailprice") < 1200, F.col("p_size") < 10, None], strict=True)), first=True)
    out = [t.read().select(F.lit(t.name).alias("target"), "p_partkey") for t in tables]
    return out[0].unionByName(out[1]).unionByName(out[2])


@_query("SELECT CAST(p_partkey AS VARCHAR) AS entity_key, CASE WHEN p_size > 40 THEN 'size' ELSE 'price' END AS error_message FROM part WHERE p_size > 40 OR p_retailprice >= 1500")
def forall_save_exceptions(spark, sf_dir):
    (table,) = _targets(spark, "parts")
    return dml.insert_logging(table, _parts(spark, sf_dir), {"size": F.col("p_size") <= 40, "price": F.col("p_retailprice") < 1500}, "p_partkey")


@_query(f"SELECT 'before' AS stage, count(*) AS n, CAST(sum(balance) AS DECIMAL(28,2)) AS total FROM ({_A}) UNION ALL SELECT 'after', 0, NULL")
def flashback_query(spark, sf_dir):
    table = _accounts(spark, sf_dir)
    before = table.update({"balance": F.col("balance")}, F.lit(True))[0]
    table.truncate()
    said = lambda df, at: df.agg(F.lit(at).alias("stage"), F.count(F.lit(1)).alias("n"), F.sum("balance").cast("decimal(28,2)").alias("total"))
    return said(table.read(before), "before").unionByName(said(table.read(), "after"))


@_query(f"SELECT k, balance, segment, 'open' AS state FROM ({_A})")
def alter_table_add(spark, sf_dir):
    table = _accounts(spark, sf_dir)
    table.add_column("state", "string", F.lit("open"))
    return table.read()


@_query("SELECT doc_id, lang FROM documents WHERE lang = 'fr'")
def partitioned_table(spark, sf_dir):
    """List partitions as folders: a query of one value reads its folder only."""
    path = fresh(spark, "tables")
    _read(spark, sf_dir, "documents").select("doc_id", "lang").repartition("lang").write.partitionBy("lang").parquet(path)
    return spark.read.schema("doc_id long, lang string").parquet(path).filter("lang = 'fr'")


@_query("SELECT o_orderkey, 100000 + row_number() OVER (ORDER BY o_orderkey) AS id FROM orders")
def sequence_nextval(spark, sf_dir):
    return row_numbers(_read(spark, sf_dir, "orders").select("o_orderkey"), [F.asc("o_orderkey")]).select("o_orderkey", (F.col("number") + 100000).cast("long").alias("id"))


@_query("SELECT c_custkey FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS r, count(*) OVER () AS n FROM customer) WHERE r <= ceil(n * 0.1)")
def fetch_percent(spark, sf_dir):
    c = _read(spark, sf_dir, "customer").select("c_custkey")
    return row_numbers(c, [F.asc("c_custkey")]).filter(F.col("number") <= F.ceil(F.lit(c.count()) * 0.1)).select("c_custkey")


@_query("""SELECT c_custkey AS o_custkey, CASE WHEN n = 1 THEN k END AS o_orderkey, CASE WHEN n = 1 THEN 'FOUND' WHEN n IS NULL THEN 'NO_DATA_FOUND' ELSE 'TOO_MANY_ROWS' END AS outcome
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, min(o_orderkey) AS k FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey) ON o_custkey = c_custkey""")
def select_into(spark, sf_dir):
    asked = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return dml.select_into(_read(spark, sf_dir, "orders").filter("o_orderstatus = 'P'"), "o_custkey", "o_orderkey", asked)


@_query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def external_table(spark, sf_dir):
    """Delimited text outside the database; lines that don't fit the columns would go to a column of their own."""
    path = fresh(spark, "tables")
    _read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey").write.option("header", True).csv(path)
    rows = spark.read.schema("n_nationkey int, n_name string, n_regionkey int, bad string").option("header", True).option("columnNameOfCorruptRecord", "bad").csv(path)
    return rows.filter("bad is null").drop("bad")


@_query("SELECT c_custkey, CASE WHEN c_acctbal IS NOT NULL THEN CAST(round(CAST(c_acctbal AS DECIMAL(18,2)) * 2, 2) AS DECIMAL(20,2)) END AS doubled FROM customer")
def udf_scalar(spark, sf_dir):
    doubled = user.scalar(lambda x: (money(x) * 2).cast("decimal(20,2)"))
    return _read(spark, sf_dir, "customer").select("c_custkey", doubled(F.col("c_acctbal")).alias("doubled"))


@_query("SELECT p_brand, CAST(exp(avg(ln(p_retailprice))) AS DECIMAL(16,4)) AS mean FROM part GROUP BY p_brand")
def udf_aggregate(spark, sf_dir):
    return _read(spark, sf_dir, "part").groupBy("p_brand").agg(user.geometric_mean(F.col("p_retailprice")).cast("decimal(16,4)").alias("mean"))


@_query("SELECT p_partkey, CAST(lo AS INT) AS lo, CAST(least(p_size, lo + 9) AS INT) AS hi FROM part, LATERAL (SELECT unnest(range(1, p_size + 1, 10)) AS lo)")
def pipelined_function(spark, sf_dir):
    user.register_pipelined(spark)
    return spark.sql("SELECT p_partkey, s.lo, s.hi FROM {parts}, LATERAL stretches(p_size, 10) s", parts=_read(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("int").alias("p_size")))


@_query("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'low' WHEN c_acctbal < 5000 THEN 'mid' ELSE 'high' END AS slab FROM customer")
def sql_macro(spark, sf_dir):
    user.macro(spark, "slab_of", "x DOUBLE", "STRING", "CASE WHEN x < 0 THEN 'low' WHEN x < 5000 THEN 'mid' ELSE 'high' END")
    return spark.sql("SELECT c_custkey, slab_of(c_acctbal) AS slab FROM {customer}", customer=_read(spark, sf_dir, "customer"))


@_query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def bind_variable(spark, sf_dir):
    return user.with_binds(spark, "SELECT o_orderkey FROM {orders} WHERE o_orderstatus = :status AND o_totalprice > :least", {"status": "F", "least": 100000}, orders=_read(spark, sf_dir, "orders"))


@_query("SELECT k, balance FROM (SELECT s_suppkey AS k, CAST(s_acctbal AS DECIMAL(18,2)) AS balance FROM supplier) WHERE balance > 0")
def view_over_link(spark, sf_dir):
    """A view over rows that another database holds; here those rows are delimited text in its place."""
    path = fresh(spark, "tables")
    _read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), money(F.col("s_acctbal")).alias("balance")).write.option("header", True).csv(path)
    return spark.read.schema("k long, balance decimal(18,2)").option("header", True).csv(path).filter("balance > 0")


@_query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O'")
def view_active_contracts(spark, sf_dir):
    _read(spark, sf_dir, "orders").createOrReplaceTempView("quarrylens_contracts")
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW quarrylens_active_contracts AS SELECT o_orderkey, o_custkey FROM quarrylens_contracts WHERE o_orderstatus = 'O'")
    return spark.table("quarrylens_active_contracts")


@_query("SELECT n_name, r_name, CAST(row_number() OVER (ORDER BY n_name) + 500 AS BIGINT) AS id FROM nation JOIN region ON n_regionkey = r_regionkey")
def seed_load(spark, sf_dir):
    """Rows of seeds in order of their references: parents first, then children that have one, with ids from a sequence."""
    root = fresh(spark, "tables")
    parents, children = dml.ChangingTable(spark, root, "parents"), dml.ChangingTable(spark, root, "children")
    parents.write(_read(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    seeds = _read(spark, sf_dir, "nation").select("n_name", F.col("n_regionkey").alias("r_regionkey")).join(parents.read().select("r_regionkey"), "r_regionkey", "left_semi")
    children.write(row_numbers(seeds, [F.asc("n_name")]).select("n_name", "r_regionkey", (F.col("number") + 500).cast("long").alias("id")))
    return children.read().join(parents.read(), "r_regionkey").select("n_name", "r_name", "id")


@_query("SELECT CAST(o_orderkey AS BIGINT) AS k, CAST((row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1) // 100 + 1 AS BIGINT) AS batch FROM orders")
def fetch_limit(spark, sf_dir):
    """FETCH ... BULK COLLECT INTO ... LIMIT 100, along a cursor's order."""
    rows = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("long").alias("k"), "o_totalprice")
    return dml.fetch_batches(rows, [F.desc("o_totalprice"), F.asc("k")], 100).select("k", "batch")


@_query("SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS number, 'Error in account ' || c_custkey || ': principal ' || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS line FROM customer WHERE c_acctbal < 0")
def put_line_log(spark, sf_dir):
    """What a routine's error handler prints, as a table of lines."""
    rows = _read(spark, sf_dir, "customer")
    line = F.concat(F.lit("Error in account "), F.col("c_custkey").cast("string"), F.lit(": principal "), money(F.col("c_acctbal")).cast("string"))
    return dml.put_lines(rows, banking.simple_interest(F.col("c_acctbal"), F.lit(5), F.lit(30), F.lit("365"))[1] == -20001, line, [F.asc("c_custkey")])


@_query("SELECT c_custkey AS account_id, c_name AS account_name, CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM customer WHERE c_acctbal > 0")
def view_active_accounts(spark, sf_dir):
    _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("account_id"), F.col("c_name").alias("account_name"), money(F.col("c_acctbal")).alias("balance")).createOrReplaceTempView("quarrylens_accounts")
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW quarrylens_active_accounts AS SELECT account_id, account_name, balance FROM quarrylens_accounts WHERE balance > 0")
    return spark.table("quarrylens_active_accounts")


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
