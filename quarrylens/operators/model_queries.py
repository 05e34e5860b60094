"""Models over line items by supplier and month, each with the SQL that it is held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .model import ANY, Model, Rule

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


_MONTHS = """SELECT CAST(l_suppkey AS BIGINT) AS supplier, CAST((year(l_shipdate) - 1990) * 12 + month(l_shipdate) AS BIGINT) AS month, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty FROM lineitem GROUP BY 1, 2"""


def _months(spark, sf_dir: str) -> DataFrame:
    return spark.sql(_MONTHS.replace("FROM lineitem", "FROM {lineitem}"), lineitem=spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


@_query(f"""WITH q AS ({_MONTHS}), c AS (SELECT a.supplier, a.month, a.qty, a.qty - b.qty AS rise FROM q a LEFT JOIN q b ON b.supplier = a.supplier AND b.month = a.month - 1)
SELECT * FROM c UNION ALL SELECT supplier, 0, CAST(sum(qty) AS BIGINT), CAST(NULL AS BIGINT) FROM q GROUP BY supplier
UNION ALL SELECT supplier, m, CAST(sum(qty) FILTER (month <= m - 1000) AS BIGINT), CAST(NULL AS BIGINT) FROM q, (VALUES (1040), (1060), (1080)) t(m) GROUP BY supplier, m""")
def model_clause(spark, sf_dir):
    """Rises on the month before; totals in cells that UPSERT adds, one by name and three by FOR."""
    total = lambda c: c.over(sum, "qty", month=lambda m: 0 < m < 1000)
    until = lambda c: c.over(sum, "qty", month=lambda m: 0 < m <= c.cv("month") - 1000)
    rules = [Rule("rise", {"month": ANY}, lambda c: c("qty") - c("qty", month=c.cv("month") - 1)), Rule("qty", {"month": 0}, total), Rule("qty", {"month": range(1040, 1081, 20)}, until)]
    return Model(["supplier"], ["month"], {"qty": "bigint", "rise": "bigint"}, rules).apply(_months(spark, sf_dir)).select("supplier", "month", "qty", "rise")


@_query(f"""WITH RECURSIVE q AS ({_MONTHS}), r(supplier, month, qty, state) AS (SELECT a.supplier, a.month, a.qty, a.qty % 1000003 FROM q a WHERE NOT EXISTS (SELECT 1 FROM q b WHERE b.supplier = a.supplier AND b.month = a.month - 1)
    UNION ALL SELECT q.supplier, q.month, q.qty, (r.state * 3 + q.qty) % 1000003 FROM r JOIN q ON q.supplier = r.supplier AND q.month = r.month + 1)
SELECT supplier, month, CAST(state AS BIGINT) AS state, CAST(state * 2 + 1 AS BIGINT) AS twice FROM r""")
def model_automatic(spark, sf_dir):
    """Automatic order: `twice` stands first and needs `state`, each of which needs the month before's; missing cells are 0."""
    rules = [Rule("twice", {"month": ANY}, lambda c: c("state") * 2 + 1), Rule("state", {"month": ANY}, lambda c: (c("state", month=c.cv("month") - 1) * 3 + c("qty")) % 1000003)]
    model = Model(["supplier"], ["month"], {"qty": "bigint", "state": "bigint", "twice": "bigint"}, rules, automatic=True, ignore_nav=True)
    return model.apply(_months(spark, sf_dir)).select("supplier", "month", "state", "twice")


@_query(f"""SELECT supplier, CAST(list_reduce(list_concat([sum(qty)], range(0, 30)), lambda x, i: CASE WHEN x < 100 THEN x ELSE x // 2 + 1 END) AS BIGINT) AS left_over,
CAST(list_reduce(list_concat([CAST(0 AS BIGINT)], range(0, 30)), lambda n, i: CASE WHEN n > 0 AND list_reduce(list_concat([sum(qty)], range(0, n)), lambda x, j: x // 2 + 1) < 100 THEN n ELSE n + 1 END) AS BIGINT) AS steps
FROM ({_MONTHS}) GROUP BY supplier HAVING sum(qty) >= 100""")
def model_iterate(spark, sf_dir):
    """ITERATE (30) UNTIL: halved until below 100, with the number of steps; only updated cells are returned."""
    sums = _months(spark, sf_dir).groupBy("supplier").agg(F.sum("qty").alias("left_over")).filter("left_over >= 100").withColumn("cell", F.lit("all"))
    rules = [Rule("left_over", {"cell": "all"}, lambda c: c("left_over") // 2 + 1), Rule("steps", {"cell": "all"}, lambda c: c.iteration + 1)]
    model = Model(["supplier"], ["cell"], {"left_over": "bigint", "steps": "bigint"}, rules, iterate=30, until=lambda c: c("left_over", cell="all") < 100, only_updated=True)
    return model.apply(sums).select("supplier", "left_over", "steps")


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
