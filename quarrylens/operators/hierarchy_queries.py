"""Hierarchies over the driver's tables, each with the recursion in SQL that it is held against.

Customers form a tree: chains of `length` customers, whose first is led by the first of the chain a quarter as far on. Orders hang below customers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.oracle import money
from . import hierarchy
from .hierarchy import BREADTH, DEPTH

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _tree(length: int) -> str:
    """(id, parent, name, balance) of customers, in both engines' SQL: whole numbers only."""
    chain = f"((c_custkey - 1 - (c_custkey - 1) % {length}) / {length})"
    whole = lambda x: f"CAST({x} AS BIGINT)"
    above = f"((({chain} - 1) - ({chain} - 1) % 4) / 4) * {length} + 1"
    parent = f"CASE WHEN (c_custkey - 1) % {length} > 0 THEN {whole('c_custkey - 1')} WHEN c_custkey > 1 THEN {whole(above)} END"
    return f"SELECT {whole('c_custkey')} AS id, {parent} AS parent, c_name AS name, CAST(c_acctbal AS DECIMAL(18,2)) AS balance, CAST(c_nationkey AS INT) AS nation FROM customer"


def _customers(spark, sf_dir: str, length: int) -> DataFrame:
    return spark.sql(_tree(length).replace("FROM customer", "FROM {customer}"), customer=spark.read.parquet(f"{sf_dir}/customer.parquet"))


def _walk(length: int, start: str = "parent IS NULL", order: str = "id") -> str:
    """The recursion: `way` has each row's place among all along the order of siblings, from the root down."""
    return f"""WITH RECURSIVE t AS ({_tree(length)}), n AS (SELECT *, row_number() OVER (ORDER BY {order}) AS seat FROM t),
h(id, parent, level, root, path, way) AS (SELECT id, parent, 1, id, [id], [seat] FROM n WHERE {start}
    UNION ALL SELECT n.id, n.parent, h.level + 1, h.root, list_append(h.path, n.id), list_append(h.way, n.seat) FROM n JOIN h ON n.parent = h.id)"""


@_query(f"{_walk(60)} SELECT h.id, h.level, array_to_string(path, '/') AS path, c.parent IS NULL AS is_leaf FROM h LEFT JOIN (SELECT DISTINCT parent FROM n WHERE parent IS NOT NULL) c ON c.parent = h.id")
def connect_by_deep(spark, sf_dir):
    """More than fifty levels: START WITH parent IS NULL CONNECT BY PRIOR id = parent, SYS_CONNECT_BY_PATH and CONNECT_BY_ISLEAF."""
    found = hierarchy.connect_by(_customers(spark, sf_dir, 60), "id", "parent", F.col("parent").isNull())
    return found.select("id", "level", F.array_join("path", "/").alias("path"), "is_leaf")


@_query(f"{_walk(4, 'nation = 7')} SELECT id, root, level FROM h")
def connect_by_root(spark, sf_dir):
    """Several roots, some below others, so rows occur more than once."""
    return hierarchy.connect_by(_customers(spark, sf_dir, 4), "id", "parent", F.col("nation") == 7).select("id", "root", "level")


@_query(f"{_walk(5, order='balance DESC, id')} SELECT id, level, CAST(row_number() OVER (ORDER BY way) AS BIGINT) AS place FROM h")
def order_siblings(spark, sf_dir):
    """ORDER SIBLINGS BY balance DESC: depth-first places over the whole result."""
    found = hierarchy.connect_by(_customers(spark, sf_dir, 5), "id", "parent", F.col("parent").isNull(), [F.desc("balance")], search=DEPTH)
    return found.select("id", "level", F.col("place").cast("long").alias("place"))


@_query(f"{_walk(6, order='name, id')} SELECT id, CAST(row_number() OVER (ORDER BY way) AS BIGINT) AS seq FROM h")
def search_depth_first(spark, sf_dir):
    found = hierarchy.connect_by(_customers(spark, sf_dir, 6), "id", "parent", F.col("parent").isNull(), [F.asc("name")], search=DEPTH)
    return found.select("id", F.col("place").cast("long").alias("seq"))


@_query(f"{_walk(6, order='name DESC, id')} SELECT id, CAST(row_number() OVER (ORDER BY level, way) AS BIGINT) AS seq FROM h")
def search_breadth_first(spark, sf_dir):
    found = hierarchy.connect_by(_customers(spark, sf_dir, 6), "id", "parent", F.col("parent").isNull(), [F.desc("name")], search=BREADTH)
    return found.select("id", F.col("place").cast("long").alias("seq"))


_LOOPS = "SELECT id - 3 AS id, id AS parent FROM t WHERE id % 12 = 4"


@_query(f"""WITH RECURSIVE t AS ({_tree(4)}), e AS (SELECT id, parent FROM t WHERE parent IS NOT NULL UNION ALL {_LOOPS}),
h(id, level, path) AS (SELECT id, 1, [id] FROM t WHERE parent IS NULL UNION ALL SELECT e.id, h.level + 1, list_append(h.path, e.id) FROM e JOIN h ON e.parent = h.id WHERE NOT list_contains(h.path, e.id)),
b AS (SELECT h.path, bool_or(list_contains(h.path, e.id)) AS is_cycle, bool_or(NOT list_contains(h.path, e.id)) AS inside FROM h JOIN e ON e.parent = h.id GROUP BY h.path)
SELECT id, level, coalesce(is_cycle, FALSE) AS is_cycle, NOT coalesce(inside, FALSE) AS is_leaf FROM h LEFT JOIN b ON b.path = h.path""")
def cycle_guard(spark, sf_dir):
    """CONNECT BY NOCYCLE: every third chain's last customer leads to its first."""
    tree = _customers(spark, sf_dir, 4)
    loops = tree.filter("id % 12 = 4").select((F.col("id") - 3).alias("id"), F.col("id").alias("parent"))
    return hierarchy.connect_by(tree, "id", "parent", F.col("parent").isNull(), nocycle=True, edges=loops).select("id", "level", "is_cycle", "is_leaf")


@_query(f"{_walk(3, 'nation = 3')} SELECT id, level, path[1] AS first FROM h WHERE level <= 3")
def connect_by(spark, sf_dir):
    """LEVEL <= 3 ends the walk."""
    found = hierarchy.connect_by(_customers(spark, sf_dir, 3), "id", "parent", F.col("nation") == 3, most_levels=3)
    return found.select("id", "level", F.element_at("path", 1).alias("first"))


@_query(f"""{_walk(5)}, s AS (SELECT o_custkey AS id, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS own FROM orders GROUP BY o_custkey)
SELECT boss AS id, CAST(sum(own) AS DECIMAL(28,2)) AS below FROM (SELECT id, unnest(path) AS boss FROM h) JOIN s USING (id) GROUP BY boss""")
def with_recursive(spark, sf_dir):
    """What orders of a customer and of all below it come to: a roll-up along the paths."""
    walked = hierarchy.connect_by(_customers(spark, sf_dir, 5), "id", "parent", F.col("parent").isNull())
    own = spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy(F.col("o_custkey").cast("long").alias("id")).agg(F.sum(money(F.col("o_totalprice"))).alias("own"))
    each = walked.join(own, "id").select(F.explode("path").alias("id"), "own")
    return each.groupBy("id").agg(F.sum("own").cast("decimal(28,2)").alias("below"))


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
