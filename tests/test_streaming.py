"""The velocity rule on a stream: late and repeated events, restart, and the same result as a batch."""

import os

from pyspark.sql import functions as F

from quarrylens.streaming import velocity as v

SHAPE = "event_id long, ts timestamp, user_id long"


def put(spark, folder, name, rows, at):
    spark.createDataFrame(rows, "event_id long, t string, user_id long").select("event_id", F.to_timestamp("t").alias("ts"), "user_id").coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
    for f in (folder / name).iterdir():
        os.utime(f, (at, at))


def test_stream(spark, tmp_path):
    first = [(k, f"2026-01-01 00:0{k}:00", 1) for k in range(5)] + [(0, "2026-01-01 00:00:00", 1), (9, "2026-01-01 00:02:00", 2)]
    put(spark, tmp_path, "in_a", first, 1)
    put(spark, tmp_path, "in_b", [(20, "2026-01-01 05:00:00", 3)], 2)
    put(spark, tmp_path, "in_b2", [(21, "2026-01-01 05:00:10", 3)], 2.5)  # the watermark holds for late rows one batch after it moves
    put(spark, tmp_path, "in_c", [(30, "2026-01-01 00:01:00", 1), (31, "2026-01-01 05:00:30", 3)], 3)

    def run():
        stream = spark.readStream.schema(SHAPE).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in_*")
        query = v.start(v.velocity(stream), f"{tmp_path}/out", f"{tmp_path}/check")
        query.awaitTermination()
        return sorted((r.user_id, str(r.window_start), r.n, r.exceeds) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    closed = [(1, "2025-12-31 23:55:00", 5, True), (1, "2026-01-01 00:00:00", 5, True), (2, "2025-12-31 23:55:00", 1, False), (2, "2026-01-01 00:00:00", 1, False)]
    assert run() == closed  # the repeat counts once, the late event not at all, the open windows aren't out yet
    put(spark, tmp_path, "in_d", [(40, "2026-01-01 09:00:00", 4)], 4)
    assert run() == [*closed, (3, "2026-01-01 04:55:00", 3, False), (3, "2026-01-01 05:00:00", 3, False)]


def test_batch(spark):
    rows = [(1, "2026-01-01 00:00:00", 1), (1, "2026-01-01 00:00:00", 1), (2, "2026-01-01 00:29:59", 1), (3, "2026-01-01 01:00:00", 1), (4, None, 1)]
    events = spark.createDataFrame(rows, "event_id long, t string, user_id long").select("event_id", F.to_timestamp("t").alias("ts"), "user_id")
    assert sorted(r.n for r in v.sessions(events).collect()) == [1, 2]
    assert v.velocity(events.limit(0)).count() == 0
