"""User-defined aggregates with a state: initialise, iterate, merge, terminate, in two Arrow phases.

Each task first folds its own rows into one state a key, a batch of a key's rows at a time; only states are shuffled, and merged by key. A key that
holds most rows therefore sends one state from each task. States are Arrow values of the type given, so their size is seen; a task that holds
more than `most_states` of them passes them on and begins anew. What sums and counts can express stays with `user.Aggregate`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class StatefulAggregate:
    """iterate(state, rows) takes a pandas frame of one key's values; merge(state, state); terminate(state) gives a tuple of the columns of `returns`, or null.

    Merging must not depend on the order of states, which is that of tasks.
    """

    initialise: Callable[[], Any]
    iterate: Callable[[Any, pd.DataFrame], Any]
    merge: Callable[[Any, Any], Any]
    terminate: Callable[[Any], tuple | None]
    state: str  # type of the state
    returns: str  # columns of the result
    most_states: int = 100_000

    def by(self, rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
        """keys and the result's columns, a row for each key; a null key is a key. Without keys one row, also of no rows."""
        spark, me = rows.sparkSession, self
        kept = rows.select(*keys, *values)
        partial_type = StructType([*kept.select(*keys).schema.fields, *StructType.fromDDL(f"_state {self.state}").fields]) if keys else StructType.fromDDL(f"_state {self.state}")
        result_type = StructType([*kept.select(*keys).schema.fields, *StructType.fromDDL(self.returns).fields])
        partial_arrow, result_arrow = to_arrow_schema(partial_type), to_arrow_schema(result_type)

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            states: dict[tuple, Any] = {}
            for batch in batches:
                frame = batch.to_pandas()
                for key, group in _grouped(frame, batch, keys):
                    states[key] = me.iterate(states[key] if key in states else me.initialise(), group[values])
                if len(states) > me.most_states:
                    yield from _written([(*k, s) for k, s in states.items()], partial_arrow)
                    states = {}
            yield from _written([(*k, s) for k, s in states.items()], partial_arrow)

        def merged(table: pa.Table) -> pa.Table:
            states = table.column("_state").to_pylist()
            whole = states[0]
            for s in states[1:]:
                whole = me.merge(whole, s)
            key = [table.column(k)[0].as_py() for k in keys]
            out = me.terminate(whole)
            return pa.table([pa.array([v], t.type) for v, t in zip([*key, *(out or [None] * (len(result_arrow) - len(key)))], result_arrow, strict=True)], schema=result_arrow)

        parts = kept.mapInArrow(partial, partial_type)
        if not keys:
            none = spark.createDataFrame([(self.initialise(),)], partial_type)
            parts = parts.unionByName(none)
        return parts.groupBy(*keys).applyInArrow(merged, result_type)


def _grouped(frame: pd.DataFrame, batch: pa.RecordBatch, keys: list[str]):
    """A batch's rows by key; keys are Arrow's own values, so nulls and large numbers keep what they are."""
    if not keys:
        yield (), frame
        return
    numbers = pd.MultiIndex.from_frame(frame[keys].astype(object)).factorize()[0] if len(keys) > 1 else pd.factorize(frame[keys[0]], use_na_sentinel=False)[0]
    for _, at in pd.Series(range(len(frame))).groupby(numbers):
        first = int(at.iloc[0])
        yield tuple(batch.column(k)[first].as_py() for k in keys), frame.iloc[at.to_numpy()]


def _written(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(rows), 5_000):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[lo : lo + 5_000], strict=True), schema, strict=True)], schema=schema)


def top_with_ties(n: int, kind: str = "bigint") -> StatefulAggregate:
    """The values that fewer than n rows exceed, each with the number of its rows, greatest first. A state has n values at most, whatever the ties."""

    def cut(counts: dict) -> list[dict]:
        out, above = [], 0
        for value in sorted(counts, reverse=True):
            if above >= n:
                break
            out.append({"value": value, "rows": counts[value]})
            above += counts[value]
        return out

    def counted(state) -> dict:
        return {s["value"]: s["rows"] for s in state}

    def iterate(state, rows: pd.DataFrame):
        counts = counted(state)
        for value, k in rows.iloc[:, 0].dropna().value_counts().nlargest(len(rows)).items():
            value = value.item() if hasattr(value, "item") else value
            counts[value] = counts.get(value, 0) + int(k)
        return cut(counts)

    def merge(a, b):
        counts = counted(a)
        for s in b:
            counts[s["value"]] = counts.get(s["value"], 0) + s["rows"]
        return cut(counts)

    form = f"array<struct<value:{kind},rows:bigint>>"
    return StatefulAggregate(list, iterate, merge, lambda state: (state,), form, f"top {form}")
