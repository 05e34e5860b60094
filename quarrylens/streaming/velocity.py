"""The velocity rule on a stream of events: how many an account makes in a sliding window, and its sessions.

The same functions take a batch table. Late events are counted as long as the watermark allows; a repeated event counts once.
State is kept for each account and open window only and is dropped as the watermark passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery


def once(events: DataFrame, key: str = "event_id", late: str = "15 minutes") -> DataFrame:
    """Each event once; on a stream a repeat is known for as long as `late`. Rows without a time don't belong to any window."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if timed.isStreaming:
        return timed.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])
    return timed.filter("ts IS NOT NULL").dropDuplicates([key])


def velocity(events: DataFrame, size: str = "10 minutes", slide: str = "5 minutes", limit: int = 3, late: str = "15 minutes") -> DataFrame:
    """(user_id, window_start, n, exceeds): events of each user in each window, and whether they are more than `limit`."""
    counted = once(events, late=late).groupBy("user_id", F.window("ts", size, slide).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("user_id", F.col("w.start").alias("window_start"), "n", (F.col("n") > limit).alias("exceeds"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "15 minutes") -> DataFrame:
    """(user_id, session_start, session_end, n): runs of events with no pause of `gap` or more; the end is the last event plus the gap."""
    counted = once(events, late=late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def start(result: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends closed windows to a Parquet table, each once, also after a restart with the same checkpoint; ends when the source is read."""
    return result.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _events(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id")


def stream_velocity(spark, sf_dir: str) -> DataFrame:
    return velocity(_events(spark, sf_dir)).select("user_id", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n", "exceeds")


def stream_sessions(spark, sf_dir: str) -> DataFrame:
    return sessions(_events(spark, sf_dir)).select("user_id", F.date_format("session_start", "yyyy-MM-dd HH:mm:ss").alias("session_start"), "n")


def queries():
    return {"stream_velocity": stream_velocity, "stream_sessions": stream_sessions}


def oracle_sql():
    return {
        "stream_velocity": "SELECT user_id, strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n, count(*) > 3 AS exceeds FROM (SELECT user_id, unnest([time_bucket(INTERVAL 5 MINUTE, ts), time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE]) AS s FROM events) GROUP BY user_id, s",
        "stream_sessions": "SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start, count(*) AS n FROM (SELECT user_id, ts, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS b FROM events)) GROUP BY user_id, g",
    }
