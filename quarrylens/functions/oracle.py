"""Semantics of the analysed dialect that differ from Spark's, each in one place."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F, types as T


def money(x: Column) -> Column:
    return x.cast("decimal(18,2)")


def dec_round(x: Column, places: int = 2) -> Column:
    """ROUND on exact numbers: half away from zero, never on a double."""
    return F.round(x.cast("decimal(38,10)"), places).cast(f"decimal(18,{places})")


def empty_is_null(x: Column) -> Column:
    return F.when(x != "", x)


def concat_nulls(*parts: Column) -> Column:
    """|| takes null as the empty text."""
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def _null_if_any(f, *xs: Column) -> Column:
    some = F.lit(False)
    for x in xs:
        some = some | x.isNull()
    return F.when(~some, f(*xs))


def greatest(*xs: Column) -> Column:
    """Null if any argument is."""
    return _null_if_any(F.greatest, *xs)


def least(*xs: Column) -> Column:
    return _null_if_any(F.least, *xs)


def trunc_day(x: Column) -> Column:
    return F.date_trunc("day", x)


def days_between(later: Column, earlier: Column) -> Column:
    """DATE - DATE: days with their fraction, exact to the second."""
    seconds = F.unix_timestamp(later.cast("timestamp")) - F.unix_timestamp(earlier.cast("timestamp"))
    return seconds.cast("decimal(20,0)") / F.lit(86400).cast("decimal(5,0)")


def number_text(x: Column) -> Column:
    """A number as text without trailing zeros of its scale."""
    return F.regexp_replace(F.regexp_replace(x.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")


# Native types and what they become.
_INTEGERS = "BINARY_INTEGER PLS_INTEGER NATURAL NATURALN POSITIVE POSITIVEN SIGNTYPE SIMPLE_INTEGER INTEGER INT SMALLINT".split()
_TEXTS = "VARCHAR2 VARCHAR CHAR NCHAR NVARCHAR2 CHARACTER STRING LONG CLOB NCLOB ROWID UROWID XMLTYPE SDO_GEOMETRY BFILE MLSLABEL".split()
_BINARY = "RAW BLOB".split()


def map_type(declared: str) -> tuple[str, T.DataType]:
    """(normalised type, Spark type) of a declared column type; a bare NUMBER is DECIMAL(38,10)."""
    m = re.match(r"\s*([A-Za-z_0-9]+(?:\s+(?:PRECISION|RAW|YEAR|DAY|WITH)\b[^(]*)?)\s*(?:\(\s*(\*|\d+)\s*(?:,\s*(-?\d+))?[^)]*\))?(.*)", declared.upper())
    if not m:
        return "UNKNOWN", T.StringType()
    name, precision, scale, rest = m[1].strip(), m[2], m[3], m[4].strip()
    if name in ("NUMBER", "DECIMAL", "DEC", "NUMERIC"):
        if precision is None:
            return "DECIMAL", T.DecimalType(38, 10)
        return "DECIMAL", T.DecimalType(38 if precision == "*" else int(precision), int(scale or 0))
    if name in _INTEGERS:
        return "INTEGER", T.LongType() if name in ("INTEGER", "INT") else T.IntegerType()
    if name in ("BINARY_FLOAT", "REAL"):
        return "FLOAT", T.FloatType()
    if name in ("BINARY_DOUBLE", "DOUBLE PRECISION", "FLOAT", "DOUBLE"):
        return "DOUBLE", T.DoubleType()
    if name.startswith("INTERVAL"):
        return "INTERVAL", T.YearMonthIntervalType() if "YEAR" in name + rest else T.DayTimeIntervalType()
    if name == "DATE" or name.startswith("TIMESTAMP"):
        return "TIMESTAMP" if name != "DATE" else "DATETIME", T.TimestampType()
    if name == "BOOLEAN":
        return "BOOLEAN", T.BooleanType()
    if name in _BINARY or name == "LONG RAW":
        return "BINARY", T.BinaryType()
    return ("STRING", T.StringType()) if name in _TEXTS else ("UNKNOWN", T.StringType())
