"""Spreadsheet rules over a relation (MODEL): cells addressed by dimensions, updated or added by rules, partition by partition.

Spark deals the partitions over tasks; a partition's cells, which are as many as its dimensions' values make, are held in its task, and a
partition of more than `most_cells` is refused before anything runs. Rules are small functions of a cell. They run in the order
given, cells of a rule in the order of their dimensions, or in automatic order: a cell is computed when another asks for it.

A target gives a value for each dimension: a literal, ANY, a list or range (FOR, in that order) or a predicate. Literals and lists
name cells, which UPSERT adds where they are missing; ANY and predicates choose among the cells there are. A value that is missing or null is
None, 0 with ignore_nav; arithmetic with None gives null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from itertools import product
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, functions as F


class ANY:
    """Every value of a dimension."""

MOST_CELLS = 200_000


@dataclass
class Rule:
    """measure[target] = value(cell)."""

    measure: str
    target: dict[str, Any]
    value: Callable[[Cell], Any]
    upsert: bool = True
    descending: bool = False


@dataclass
class Model:
    """partition and dimensions are columns that name a cell; measures (name -> type) are its values, null where the rows have none of that name."""

    partition: list[str]
    dimensions: list[str]
    measures: dict[str, str]
    rules: list[Rule]
    automatic: bool = False
    iterate: int = 1
    until: Callable[[Cell], bool] | None = None
    ignore_nav: bool = False
    only_updated: bool = False  # RETURN UPDATED ROWS
    most_cells: int = field(default=MOST_CELLS)

    def apply(self, rows: DataFrame) -> DataFrame:
        """One row for each cell. Two rows of one cell are an error, as it would not be clear which counts."""
        keys = [*self.partition, *self.dimensions]
        largest = rows.groupBy(*self.partition).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        if largest > self.most_cells:
            raise ValueError(f"a partition has {largest} cells; a task holds {self.most_cells}")
        if not rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
            raise ValueError("several rows are one cell")
        values = [(F.col(m) if m in rows.columns else F.lit(None)).cast(t).alias(m) for m, t in self.measures.items()]
        cells = rows.select(*keys, *values)
        names = cells.columns

        def solve(group: pd.DataFrame) -> pd.DataFrame:
            sheet = Sheet(self, group)
            sheet.run()
            return pd.DataFrame(sheet.rows(), columns=names)

        return cells.groupBy(*self.partition).applyInPandas(solve, cells.schema)


class Sheet:
    """One partition's cells: by their dimensions' values, a list of measures."""

    def __init__(self, model: Model, group: pd.DataFrame):
        self.model, self.place = model, {m: k for k, m in enumerate(model.measures)}
        p, d = len(model.partition), len(model.dimensions)
        plain = [[None if x is None or x is pd.NaT or x != x else x.item() if hasattr(x, "item") else x for x in row] for row in group.itertuples(index=False, name=None)]
        self.partition = plain[0][:p]
        self.cells = {tuple(row[p : p + d]): row[p + d :] for row in plain}
        self.before: dict = {}
        self.pending: dict[tuple, Rule | None] = {}
        self.updated: set = set()
        self.iteration = 0

    def rows(self):
        return [(*self.partition, *key, *values) for key, values in self.cells.items() if key in self.updated or not self.model.only_updated]

    def targets(self, rule: Rule) -> list[tuple]:
        wanted = [rule.target.get(d, ANY) for d in self.model.dimensions]
        if any(w is ANY or callable(w) for w in wanted):
            fits = lambda w, x: w is ANY or (bool(w(x)) if callable(w) else x in w if _listed(w) else x == w)
            found = sorted((k for k in self.cells if all(map(fits, wanted, k))), key=_by_value)
        else:
            found = [k for k in product(*[w if _listed(w) else [w] for w in wanted]) if rule.upsert or k in self.cells]
        return found[::-1] if rule.descending else found

    def compute(self, rule: Rule, key: tuple) -> None:
        self.pending.pop((rule.measure, key), None)
        self.pending[rule.measure, key] = None  # being computed
        try:
            value = rule.value(Cell(self, key))
        except TypeError:  # arithmetic with a null
            value = None
        del self.pending[rule.measure, key]
        self.cells.setdefault(key, [None] * len(self.place))[self.place[rule.measure]] = value
        self.updated.add(key)

    def get(self, measure: str, key: tuple):
        if (measure, key) in self.pending:
            rule = self.pending[measure, key]
            if rule is None and self.model.automatic:
                raise ValueError(f"the rules of {measure} depend on one another")
            if rule is not None:
                self.compute(rule, key)
        found = self.cells.get(key)
        value = None if found is None else found[self.place[measure]]
        return 0 if value is None and self.model.ignore_nav else value

    def run(self) -> None:
        for self.iteration in range(self.model.iterate):
            self.before = {k: list(v) for k, v in self.cells.items()} if self.model.until else {}
            if self.model.automatic:
                self.pending = {(rule.measure, key): rule for rule in self.model.rules for key in self.targets(rule)}
                while self.pending:
                    (_, key), rule = next(iter(self.pending.items()))
                    self.compute(rule, key)
            else:
                for rule in self.model.rules:
                    for key in self.targets(rule):
                        self.compute(rule, key)
            if self.model.until and self.model.until(Cell(self, (None,) * len(self.model.dimensions))):
                break


class Cell:
    """What a rule's right-hand side sees: cell("m", dimension=value) is another cell's measure, dimensions left out are this cell's own."""

    def __init__(self, sheet: Sheet, key: tuple):
        self._sheet, self._key = sheet, key

    @property
    def iteration(self) -> int:
        return self._sheet.iteration

    def cv(self, dimension: str):
        return self._key[self._sheet.model.dimensions.index(dimension)]

    def _at(self, where: dict) -> tuple:
        return tuple(where.get(d, own) for d, own in zip(self._sheet.model.dimensions, self._key, strict=True))

    def __call__(self, measure: str, **where):
        return self._sheet.get(measure, self._at(where))

    def present(self, **where) -> bool:
        """IS PRESENT: the cell was there before the rules added any, or has been added."""
        return self._at(where) in self._sheet.cells

    def previous(self, measure: str, **where):
        """PREVIOUS: the value before this iteration."""
        found = self._sheet.before.get(self._at(where))
        return None if found is None else found[self._sheet.place[measure]]

    def over(self, of: Callable[[Iterable], Any], measure: str, **where):
        """An aggregate of the non-null values of the cells that where fits: values, ANY, lists or predicates by dimension, this cell's own for the rest."""
        rule = Rule(measure, {d: where.get(d, own) for d, own in zip(self._sheet.model.dimensions, self._key, strict=True)}, lambda c: None, upsert=False)
        found = [v for key in self._sheet.targets(rule) if (v := self._sheet.get(measure, key)) is not None]
        return of(found) if found else None


def _listed(w) -> bool:
    return isinstance(w, (list, range, tuple))


def _by_value(key: tuple):
    return [(x is not None, x) if x is not None else (False, 0) for x in key]
