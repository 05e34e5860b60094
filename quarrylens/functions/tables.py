"""Table functions over tables: PARALLEL_ENABLE with a partitioning, and rows in order, as Arrow table functions with a TABLE argument.

Spark deals a table's parts over tasks (PARTITION BY), sorts each (ORDER BY) and hands it on in batches, so a part streams through its
task, whatever its size; what a function keeps between batches is its own few values. The functions pipe their rows batch by batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

SESSIONS, SKETCH = "user bigint, started timestamp_ntz, ended timestamp_ntz, events bigint", "key bigint, rows bigint, low double, high double"


class Sessions:
    """Sessions of one user's events in order of time: a new one begins after a pause of more than half an hour. (user bigint, ts timestamp_ntz)."""

    pause = np.timedelta64(30 * 60, "s")

    def __init__(self):
        self.user = self.started = self.last = None
        self.events = 0

    def eval(self, events: pa.RecordBatch) -> Iterator[pa.Table]:
        times = events.column("ts").to_numpy(zero_copy_only=False).astype("datetime64[us]")
        self.user = events.column("user")[0].as_py()
        times = times[~np.isnat(times)]  # an event without a time is in no session
        if not len(times):
            return
        breaks = np.flatnonzero(np.diff(times) > self.pause) + 1
        if self.last is not None and times[0] - self.last > self.pause:
            breaks = np.concatenate(([0], breaks))
        if self.started is None:
            self.started = times[0]
        done, at = [], 0
        for b in breaks:
            last = times[b - 1] if b else self.last
            done.append((self.user, self.started, last, self.events + int(b - at)))
            self.started, self.events, at = times[b], 0, int(b)
        self.events, self.last = self.events + len(times) - at, times[-1]
        if done:
            yield self._table(done)

    def terminate(self) -> Iterator[pa.Table]:
        if self.started is not None:
            yield self._table([(self.user, self.started, self.last, self.events)])

    @staticmethod
    def _table(rows: list[tuple]) -> pa.Table:
        user, started, ended, events = zip(*rows, strict=True)
        at = lambda x: pa.array(np.array(x, "datetime64[us]"), pa.timestamp("us"))
        return pa.table({"user": pa.array(user, pa.int64()), "started": at(started), "ended": at(ended), "events": pa.array(events, pa.int64())})


class Extent:
    """(key bigint, x double), dealt by hash: rows, least and greatest value of one key; the order of rows doesn't matter."""

    def __init__(self):
        self.key, self.rows, self.low, self.high = None, 0, None, None

    def eval(self, part: pa.RecordBatch) -> Iterator[pa.Table]:
        x = part.column("x").drop_null().to_numpy(zero_copy_only=False)
        self.key, self.rows = part.column("key")[0].as_py(), self.rows + part.num_rows
        if len(x):
            self.low = x.min() if self.low is None else min(self.low, x.min())
            self.high = x.max() if self.high is None else max(self.high, x.max())
        return iter(())

    def terminate(self) -> Iterator[pa.Table]:
        yield pa.table({"key": pa.array([self.key], pa.int64()), "rows": pa.array([self.rows], pa.int64()), "low": pa.array([self.low], pa.float64()), "high": pa.array([self.high], pa.float64())})


def register(spark: SparkSession) -> None:
    """`sessions(TABLE(t) PARTITION BY user ORDER BY ts)` and `extent(TABLE(t) PARTITION BY key)` in SQL."""
    spark.udtf.register("sessions", F.arrow_udtf(Sessions, returnType=SESSIONS))
    spark.udtf.register("extent", F.arrow_udtf(Extent, returnType=SKETCH))


def sessions(events: DataFrame) -> DataFrame:
    """Sessions of events (user, ts), by the DataFrame form of the call."""
    return F.arrow_udtf(Sessions, returnType=SESSIONS)(events.select("user", "ts").asTable().partitionBy("user").orderBy("ts"))
