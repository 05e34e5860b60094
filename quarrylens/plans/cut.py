"""Written tables that cut a plan: lost executors reread them, and later plans start shallow."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def shared_root(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir. Only a local session may leave it unset: then a folder of this machine; elsewhere that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = f"file://{tempfile.gettempdir()}/quarrylens-checkpoints"
    return root.rstrip("/")


def fresh(spark: SparkSession, kind: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_root(spark)}/{kind}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """df written below the shared folder and read again."""
    path = fresh(df.sparkSession, "code")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def big(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the input: it is sorted and merged, never sent through the driver.

    Spark guesses a side from the size of its files. Those of written facts are small (texts repeat themselves) and hold arrays
    that burst into many rows, so the guess may be a hundredth of what would be sent.
    """
    return df.hint("merge")


def tasks_of(spark: SparkSession) -> int:
    """Tasks for work that costs far more than the size of its rows tells."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def side_by_side(*works: Callable[[], DataFrame]) -> list[DataFrame]:
    """Results of works that don't wait for each other; their jobs share the session's executors."""
    with ThreadPoolExecutor(len(works)) as pool:
        return list(pool.map(lambda work: work(), works))


def row_numbers(df: DataFrame, order: list[Column], name: str = "number") -> DataFrame:
    """df with `name`, 1, 2, 3 ... along an order. Ranges of the order are numbered apart and shifted by the rows of the ranges before them, so no task holds all rows."""
    parts = settled(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = parts.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))  # a row for each range
    before = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return parts.join(F.broadcast(before), "_range").withColumn(name, place + F.col("_before")).drop("_range", "_before")
