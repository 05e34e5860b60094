"""XMLTABLE: rows and columns of XML texts by paths, each text parsed once.

The paths make the type that `from_xml` reads a text into; every step may repeat, so every step is an array, and rows are what is left when the
row path's steps are laid flat. Namespaces are left out of names. A text that is no XML, or whose root has another name, gives no rows; `faults` names it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

_BAD = "_unread"
_OPTIONS = {"ignoreNamespace": "true", "columnNameOfCorruptRecord": _BAD, "ignoreSurroundingSpaces": "false"}
_ROOT = r"(?s)^\s*(?:<\?.*?\?>\s*|<!--.*?-->\s*|<!DOCTYPE[^>]*>\s*)*<(?:[\w.-]+:)?([\w.-]+)"


@dataclass(frozen=True)
class XmlColumn:
    """A column of a row: PATH (`a/b`, `@id`, `a/@id`, `.`), its first value where there are several, DEFAULT where there is none; or FOR ORDINALITY."""

    name: str
    type: str = "string"
    path: str = "."
    default: object = None
    ordinality: bool = False


@dataclass(frozen=True)
class Nested:
    """NESTED PATH: rows below a row, which stays with nulls where it has none."""

    path: str
    columns: tuple[XmlColumn, ...]


@dataclass
class _Element:
    attributes: set[str] = field(default_factory=set)
    children: dict[str, _Element] = field(default_factory=dict)

    def at(self, steps: list[str]) -> _Element:
        here = self
        for s in steps:
            here = here.children.setdefault(s, _Element())
        return here

    def type(self) -> str:
        parts = ["`_VALUE`:string", *[f"`_{a}`:string" for a in sorted(self.attributes)], *[f"`{n}`:array<{c.type()}>" for n, c in sorted(self.children.items())]]
        return f"struct<{','.join(parts)}>"


def _steps(path: str) -> tuple[list[str], str]:
    """The elements of a path and what it takes of the last: an attribute or its text."""
    steps = [s for s in path.strip().strip("/").split("/") if s not in ("", ".", "text()")]
    for s in steps:
        if not all(c.isalnum() or c in "_.-@:" for c in s):
            raise ValueError(f"a path with {s!r} can't be said")
    steps = [s if s.startswith("@") else s.split(":")[-1] for s in steps]
    if any(s.startswith("@") for s in steps[:-1]):
        raise ValueError(f"an attribute inside the path {path!r}")
    return (steps[:-1], "_" + steps[-1][1:].split(":")[-1]) if steps and steps[-1].startswith("@") else (steps, "_VALUE")


def _field(name: str):
    return lambda x: x.getField(name)


def _laid_flat(elements: Column, steps: list[str]) -> Column:
    for s in steps:
        elements = F.flatten(F.filter(F.transform(elements, _field(s)), lambda x: x.isNotNull()))
    return elements


def _value(row: Column, c: XmlColumn) -> Column:
    steps, of = _steps(c.path)
    found = F.get(F.filter(F.transform(_laid_flat(F.array(row), steps), _field(of)), lambda x: x.isNotNull()), F.lit(0))
    value = F.when(row.isNotNull(), found.try_cast(c.type))
    return value if c.default is None else F.when(row.isNotNull(), F.coalesce(value, F.lit(c.default).cast(c.type)))


def _parsed(rows: DataFrame, text: str, row_path: str, columns: list[XmlColumn], nested: Nested | None) -> tuple[DataFrame, list[str], str]:
    steps, of = _steps(row_path)
    if not steps or of != "_VALUE":
        raise ValueError(f"no rows at {row_path!r}")
    tree = _Element()
    row = tree.at(steps[1:])
    for at, cs in ((row, columns), *([(row.at(_steps(nested.path)[0]), nested.columns)] if nested else [])):
        for c in cs:
            if not c.ordinality:
                inner, taken = _steps(c.path)
                element = at.at(inner)
                if taken != "_VALUE":
                    element.attributes.add(taken[1:])
    whole = tree.type()
    root = F.regexp_extract(F.col(text), _ROOT, 1)
    parsed = rows.withColumn("_xml", F.from_xml(F.col(text), f"{whole[7:-1]},`{_BAD}`:string".replace("`_VALUE`:string,", "`_VALUE` string,").replace("`:", "` "), _OPTIONS))
    return parsed.withColumn("_fits", root == steps[0]), steps, whole


def xml_table(rows: DataFrame, text: str, row_path: str, columns: list[XmlColumn], nested: Nested | None = None) -> DataFrame:
    """rows' columns without the text, and the table's columns: a row for each element at row_path (and each nested one)."""
    parsed, steps, _ = _parsed(rows, text, row_path, columns, nested)
    kept = [c for c in rows.columns if c != text]
    found = _laid_flat(F.array("_xml"), steps[1:])
    ok = F.col("_fits") & F.col(f"_xml.{_BAD}").isNull()
    out = parsed.filter(ok).select(*kept, F.posexplode(found).alias("_place", "_row"))
    row, shown = F.col("_row"), []
    for c in columns:
        shown.append(((F.col("_place") + 1).cast("int") if c.ordinality else _value(row, c)).alias(c.name))
    if nested:
        out = out.select(*kept, "_place", "_row", F.posexplode_outer(_laid_flat(F.array("_row"), _steps(nested.path)[0])).alias("_inner_place", "_inner"))
        for c in nested.columns:
            shown.append(((F.col("_inner_place") + 1).cast("int") if c.ordinality else _value(F.col("_inner"), c)).alias(c.name))
    return out.select(*kept, *shown)


def faults(rows: DataFrame, text: str, row_path: str) -> DataFrame:
    """Rows whose text is no XML or has another root, with `fault`. Null texts are none."""
    parsed, steps, _ = _parsed(rows, text, row_path, [], None)
    fault = F.when(F.col(text).isNull(), None).when(F.col(f"_xml.{_BAD}").isNotNull(), "not XML").when(~F.col("_fits"), F.lit(f"root is not {steps[0]}"))
    return parsed.withColumn("fault", fault).filter("fault IS NOT NULL").drop("_xml", "_fits")
