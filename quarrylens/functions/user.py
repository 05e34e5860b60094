"""What a schema's own functions become: scalar functions, aggregates, pipelined functions, macros and bind variables.

Functions over columns stay expressions, which the optimiser sees; a pipelined function is a table function that gives rows one
by one; a macro is a SQL function, whose body is put in place of its call.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def scalar(f: Callable[..., Column]) -> Callable[..., Column]:
    """A deterministic function of columns: null in, null out, as a function declared so promises."""

    def called(*columns: Column) -> Column:
        bad = F.lit(False)
        for c in columns:
            bad = bad | c.isNull()
        return F.when(~bad, f(*columns))

    return called


class Aggregate:
    """A user-defined aggregate by its parts: per row values, how they are summed up, and the result from the sums.

    Parts are built-in aggregates, so they are combined before the shuffle, whatever the size of a group.
    """

    def __init__(self, parts: dict[str, Callable[[Column], Column]], result: Callable[[dict[str, Column]], Column]):
        self.parts, self.result = parts, result

    def __call__(self, value: Column) -> Column:
        return self.result({name: part(value) for name, part in self.parts.items()})


geometric_mean = Aggregate({"logs": lambda x: F.sum(F.when(x > 0, F.ln(x))), "n": lambda x: F.count(F.when(x > 0, x))}, lambda p: F.exp(p["logs"] / p["n"]))


class Stretches:
    """A pipelined table function: (lo, hi) pieces of at most `width` of the numbers 1..n, piped one after the other."""

    def eval(self, n: int, width: int):
        for lo in range(1, (n or 0) + 1, width):
            yield lo, min(n, lo + width - 1)


def register_pipelined(spark: SparkSession, name: str = "stretches") -> None:
    spark.udtf.register(name, F.udtf(Stretches, returnType="lo int, hi int"))


def macro(spark: SparkSession, name: str, parameters: str, returns: str, body: str) -> None:
    """A temporary SQL function of the session."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {returns} RETURN {body}")


def with_binds(spark: SparkSession, text: str, binds: dict, **tables: DataFrame) -> DataFrame:
    """A statement with named bind variables (:name), which are values and never text of the statement; {tables} by name."""
    return spark.sql(text, args=binds, **tables)
