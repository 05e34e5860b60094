"""Queries given as SQL text over the driver's tables."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def over_tables(text: str) -> Callable[[SparkSession, str], DataFrame]:
    """A query that reads, by name, the tables its text mentions; the text stays declarative for Catalyst."""
    used = [t for t in TABLES if re.search(rf"\b{t}\b", text)]

    spaced = text.replace("{", "{{").replace("}", "}}")
    if used:
        spaced = re.sub(r"\b(" + "|".join(used) + r")\b(?!\s*\.)(?=[^']*(?:'[^']*'[^']*)*$)", r"{\1}", spaced)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(spaced, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used}) if used else spark.sql(text)

    return run
