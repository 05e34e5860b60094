"""Runs of the stages as folders of tables: <root>/<stage>/<version>/<name>, and `latest.json`, which names a run once it is whole.

The pointer is written last and moved into place, so a reader sees the former run or the new one; a run that broke off is an
orphan folder. Paths may be of any file system that Spark reads.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType
from pyspark.errors import PySparkException

#: What the stages answer to a shell: done, bad input or an unfit figure, a question that is refused.
EXIT_OK, EXIT_INVALID, EXIT_REFUSED = 0, 1, 2


def run_version(now: datetime | None = None) -> str:
    """UTC time to the microsecond as a folder name; later runs sort later."""
    return (now or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime("%Y-%m-%dT%H.%M.%S.%fZ")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def point(spark: SparkSession, folder: str, content: dict) -> None:
    fs, path = _fs(spark, folder)
    new, final = path(f"{folder}/latest.json.{content['run_version']}"), path(f"{folder}/latest.json")
    out = fs.create(new, True)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    options = spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    replace = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    replace[0] = spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options.rename(new, final, replace)


def write_run(spark: SparkSession, root: str, stage: str, tables: dict[str, DataFrame], version: str | None = None, partition_by: dict[str, str] | None = None) -> str:
    """Writes each table as JSON lines (a folder for each value of a column where partition_by names one), then the pointer. Returns the version."""
    version = version or run_version()
    for name, df in tables.items():
        writer = df.write.mode("errorifexists")
        if partition_by and name in partition_by:
            writer = writer.partitionBy(partition_by[name])
        writer.option("ignoreNullFields", False).json(f"{root}/{stage}/{version}/{name}")
    point(spark, f"{root}/{stage}", {"stage": stage, "run_version": version, "tables": {k: v.schema.json() for k, v in tables.items()}})
    return version


def latest(spark: SparkSession, root: str, stage: str) -> dict:
    """The pointer's content; FileNotFoundError without a finished run, ValueError if it can't be read."""
    fs, path = _fs(spark, f"{root}/{stage}")
    at = path(f"{root}/{stage}/latest.json")
    if not fs.exists(at):
        raise FileNotFoundError(f"no finished run of {stage} below {root}")
    text = "\n".join(r.value for r in spark.read.text(at.toString(), wholetext=True).collect())
    return json.loads(text)


def load_run(spark: SparkSession, root: str, stage: str, name: str, version: str | None = None) -> DataFrame:
    """A table of the latest finished run, or of a given one, with the types it was written with."""
    pointer = latest(spark, root, stage)
    schema = StructType.fromJson(json.loads(pointer["tables"][name]))
    return spark.read.schema(schema).json(f"{root}/{stage}/{version or pointer['run_version']}/{name}")


def optional(spark: SparkSession, root: str, stage: str, name: str, schema: str, version: str | None = None) -> tuple[DataFrame, str | None]:
    """The table and its version, or an empty table of `schema` and None where the run is missing or can't be read."""
    try:
        found = load_run(spark, root, stage, name, version)
        return found, version or latest(spark, root, stage)["run_version"]
    except (FileNotFoundError, KeyError, ValueError, TypeError, PySparkException):
        return spark.createDataFrame([], schema), None
