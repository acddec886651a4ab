"""Held alerts on a stream (R5, O11): ``expr > threshold for: 5m``.

Two chained watermarked window aggregations.  The first closes the evaluation windows;
every evaluation above the threshold then votes for the instants whose hold period
covers it, a sliding window over evaluation instants, and an instant with all votes
fires.  A missing evaluation (no traffic in a window) gives no vote, so it breaks the
hold, as a missing sample does for the alerting engine.  Instants are grouped by alert
key and instant, so the work of a long history spreads over tasks; state is kept for
instants above the watermark only.  The vote takes one row per evaluation instant,
never the raw request rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from .ops import sliding_counts
from .runner import finish, rocksdb_state


def evaluation_windows(log: DataFrame, delay: str = "10 minutes", name: str = "HighErrorRate") -> DataFrame:
    """One row per closed 5-minute window (step 1 minute): requests and 5xx count."""
    return (sliding_counts(log, delay, "5 minutes", "1 minute")
              .select(F.lit(name).alias("alertname"), "w", F.col("w.end").alias("window_end"), "requests", "errors"))


def held_alert_stream(windows: DataFrame, threshold: float = C.ERROR_RATIO_RED, hold_minutes: int = 5,
                      step_minutes: int = 1) -> DataFrame:
    """Instants at which the condition held at every evaluation of the last ``hold_minutes``."""
    votes = -(-hold_minutes // step_minutes) + 1
    # a window's time is just before its end: the hold window that ends at an instant holds that instant's own vote
    held = F.window("w", f"{votes * step_minutes} minutes", f"{step_minutes} minutes").alias("hold")
    return (windows.filter(F.col("errors") / F.col("requests") > threshold)
                   .groupBy("alertname", held).agg(F.count(F.lit(1)).alias("votes"))
                   .filter(F.col("votes") == votes)
                   .select("alertname", F.col("hold.end").alias("fires_at")))


def run_alert_stream(spark: SparkSession, log: DataFrame, sink: str, checkpoint: str,
                     timeout_s: int | None = None) -> None:
    with rocksdb_state(spark):
        out = held_alert_stream(evaluation_windows(log))
        q = (out.writeStream.format("parquet").outputMode("append")
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink))
        finish(q, timeout_s)
