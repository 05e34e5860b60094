"""A schema's own aggregates and table functions over the driver's tables, each with the SQL that it is held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import aggregates, collections as co, masks, tables, xml
from ..functions.oracle import money

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _read(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("""SELECT o_orderpriority, x AS value, count(*) AS rows FROM (SELECT *, rank() OVER (PARTITION BY o_orderpriority ORDER BY x DESC) AS r
FROM (SELECT o_orderpriority, CAST(floor(o_totalprice / 10000) AS BIGINT) AS x FROM orders)) WHERE r <= 5 GROUP BY 1, 2""")
def udf_aggregate_state(spark, sf_dir):
    """The five greatest values of each priority with all their ties, out of five keys that hold all rows."""
    rows = _read(spark, sf_dir, "orders").select("o_orderpriority", F.floor(F.col("o_totalprice") / 10000).cast("bigint").alias("x"))
    found = aggregates.top_with_ties(5).by(rows, ["o_orderpriority"], ["x"])
    return found.select("o_orderpriority", F.explode("top").alias("t")).select("o_orderpriority", "t.value", "t.rows")


@_query("""SELECT user, min(ts) AS started, max(ts) AS ended, count(*) AS events FROM (SELECT *, sum(fresh) OVER (PARTITION BY user ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k
FROM (SELECT user_id AS user, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS fresh FROM events)) GROUP BY user, k""")
def table_function_ordered(spark, sf_dir):
    """A table function with its rows in order: sessions(TABLE(...) PARTITION BY user ORDER BY ts)."""
    tables.register(spark)
    return spark.sql("SELECT * FROM sessions(TABLE(SELECT user_id AS user, ts FROM {events}) PARTITION BY user ORDER BY ts)", events=_read(spark, sf_dir, "events"))


@_query("SELECT CAST(l_suppkey AS BIGINT) AS key, count(*) AS rows, min(CAST(l_extendedprice AS DOUBLE)) AS low, max(CAST(l_extendedprice AS DOUBLE)) AS high FROM lineitem GROUP BY l_suppkey")
def table_function_hashed(spark, sf_dir):
    """A table function that runs in parallel by hash of a column."""
    tables.register(spark)
    rows = _read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("bigint").alias("key"), F.col("l_extendedprice").cast("double").alias("x"))
    return spark.sql("SELECT * FROM extent(TABLE({rows}) PARTITION BY key)", rows=rows)


@_query("""SELECT o_orderkey, strftime(d, '%d/%m/%Y %H:%M:%S') AS full_date, upper(strftime(d, '%d-%b-%y')) AS short_date, strftime(d, '%B ') || day(d) || ', ' || year(d) AS words, lpad(CAST(dayofyear(d) AS VARCHAR), 3, '0') || ' ' || quarter(d) AS day_and_quarter,
format('{:,.2f}', CAST(o_totalprice AS DECIMAL(18,2))) AS price, lpad(CAST(o_orderkey % 1000 AS VARCHAR), 5, '0') || '+' AS signed, d AS back, CAST(o_totalprice AS DECIMAL(18,2)) AS price_back FROM (SELECT *, CAST(o_orderdate AS TIMESTAMP) AS d FROM orders)""")
def format_masks(spark, sf_dir):
    """Masks of dates and numbers, shown and read again."""
    rows = _read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("d"), money(F.col("o_totalprice")).alias("p"))
    d, price = F.col("d"), "FM9,999,999,990.00"
    shown = rows.select(
        "o_orderkey", masks.to_char(d, "DD/MM/YYYY HH24:MI:SS").alias("full_date"), masks.to_char(d, "DD-MON-RR").alias("short_date"), masks.to_char(d, "FMMonth DD, YYYY").alias("words"), masks.to_char(d, "DDD Q").alias("day_and_quarter"),
        masks.number_to_char(F.col("p"), price).alias("price"), masks.number_to_char(F.col("o_orderkey") % 1000, "FM00000S").alias("signed"),
    )
    back = masks.to_timestamp(F.col("full_date"), "DD/MM/YYYY HH24:MI:SS").cast("timestamp_ntz")
    return shown.select("*", back.alias("back"), masks.to_number(F.col("price"), price).cast("decimal(18,2)").alias("price_back"))


@_query("""SELECT CAST(c_custkey AS BIGINT) AS customer, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INT) AS n, CAST(o_orderkey AS BIGINT) AS order_key, CAST(o_totalprice AS DECIMAL(18,2)) AS total,
CASE WHEN o_orderkey % 3 = 0 THEN 'none' ELSE o_orderpriority END AS priority, CASE WHEN o_orderkey % 2 = 0 THEN 'a & b' END AS first_note, c_name AS name FROM orders JOIN customer ON o_custkey = c_custkey""")
def xml_table(spark, sf_dir):
    """A text for each customer with its orders, with a namespace, elements that are missing and some that repeat."""
    order = F.concat(
        F.lit('<o:order key="'), F.col("o_orderkey").cast("string"), F.lit('"><o:total>'), money(F.col("o_totalprice")).cast("string"), F.lit("</o:total>"), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.concat(F.lit("<o:priority>"), "o_orderpriority", F.lit("</o:priority>"))),
        F.when(F.col("o_orderkey") % 2 == 0, "<o:note>a &amp; b</o:note><o:note>c</o:note>").otherwise(""), F.lit("</o:order>"),
    )
    orders = _read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.struct("o_orderkey", order.alias("text")).alias("o")).groupBy("c_custkey").agg(F.array_sort(F.collect_list("o")).alias("os"))
    whole = F.concat(F.lit('<?xml version="1.0"?><!-- orders --><o:customer xmlns:o="urn:orders">'), F.array_join(F.transform("os", lambda o: o["text"]), ""), F.lit("</o:customer>"))
    texts = _read(spark, sf_dir, "customer").join(orders, "c_custkey").select(F.col("c_custkey").cast("bigint").alias("customer"), F.col("c_name").alias("name"), whole.alias("text"))
    columns = [xml.XmlColumn("n", ordinality=True), xml.XmlColumn("order_key", "bigint", "@key"), xml.XmlColumn("total", "decimal(18,2)", "total"), xml.XmlColumn("priority", path="priority", default="none"), xml.XmlColumn("first_note", path="note")]
    return xml.xml_table(texts, "text", "/customer/order", columns).select("customer", "n", "order_key", "total", "priority", "first_note", "name")


_LINES = "SELECT CAST(l_orderkey AS BIGINT) AS o, list(CAST(l_linenumber AS INT) ORDER BY l_linenumber) AS ks, list(CAST(l_quantity AS INT) % 5 ORDER BY l_linenumber) AS qs FROM lineitem GROUP BY l_orderkey"


@_query(f"""SELECT o, list_min(list_filter(ks, lambda k: k <> 2)) AS first_key, list_max(list_filter(ks, lambda k: k <> 2)) AS last_key, list_max(list_filter(ks, lambda k: k <> 2 AND k < 4)) AS before_4, list_min(list_filter(ks, lambda k: k <> 2 AND k > 1)) AS after_1,
list_contains(ks, 3) AS has_3, CAST(len(list_filter(list_distinct(ks), lambda k: k < 2 OR k > 5)) AS INT) AS left_over FROM ({_LINES})""")
def associative_tables(spark, sf_dir):
    """A table of each order's lines by number: FIRST, LAST, PRIOR, NEXT, EXISTS after a DELETE, and a DELETE of a range."""
    lines = _read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("bigint").alias("o"), F.col("l_linenumber").cast("int").alias("k")).agg(F.sum(F.col("l_quantity").cast("int")).alias("q"))
    table = lines.groupBy("o").agg(F.map_from_entries(F.collect_list(F.struct("k", "q"))).alias("t")).withColumn("d", co.delete(F.col("t"), F.lit(2)))
    d = F.col("d")
    return table.select("o", co.first(d).alias("first_key"), co.last(d).alias("last_key"), co.prior(d, F.lit(4)).alias("before_4"), co.following(d, F.lit(1)).alias("after_1"), co.exists(d, F.lit(3)).alias("has_3"), F.size(co.delete(F.col("t"), F.lit(2), F.lit(5))).alias("left_over"))


@_query(f"""SELECT o, list_sort(list_concat(qs, [1, 1, 3])) AS u, list_sort(flatten(list_transform(list_distinct(qs), lambda x: list_transform(range(0, least(len(list_filter(qs, lambda y: y = x)), len(list_filter([1, 1, 3], lambda y: y = x)))), lambda i: x)))) AS i,
list_sort(flatten(list_transform(list_distinct(qs), lambda x: list_transform(range(0, greatest(len(list_filter(qs, lambda y: y = x)) - len(list_filter([1, 1, 3], lambda y: y = x)), 0)), lambda i: x)))) AS e,
len(list_filter(qs, lambda y: y = 1)) >= 2 AND list_contains(qs, 3) AS within FROM ({_LINES})""")
def multiset_all(spark, sf_dir):
    """MULTISET UNION, INTERSECT and EXCEPT ALL, and SUBMULTISET: repeats count."""
    rows = _read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("bigint").alias("o")).agg(F.collect_list(F.col("l_quantity").cast("int") % 5).alias("q"))
    other, q = F.lit([1, 1, 3]), F.col("q")
    return rows.select("o", F.sort_array(co.union_all(q, other)).alias("u"), F.sort_array(co.intersect_all(q, other)).alias("i"), F.sort_array(co.except_all(q, other)).alias("e"), co.submultiset(other, q).alias("within"))


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
