"""Request-log rollups as a stream (R4): event-time windows with a watermark.

``withWatermark`` needs a ``timestamp`` column (``timestamp_ntz`` is rejected),
so the event time is cast first.  In append mode a window is emitted once
the watermark passes its end, so late rows within ``delay`` still count and
state for closed windows is dropped -- memory stays bounded by the open
windows, not by the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ops import is_5xx
from .runner import finish


def sliding_counts(log: DataFrame, delay: str, duration: str, slide: str, by=()) -> DataFrame:
    """Requests and 5xx per sliding window ``w``: raw rows are counted once per slide step, and only those
    counts are fanned out to the windows that hold them."""
    ts = log.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    steps = (ts.groupBy(F.window("ts", slide).alias("step"), *by)
               .agg(F.count(F.lit(1)).alias("n"), F.count_if(is_5xx()).alias("n_5xx")))
    return (steps.groupBy(F.window("step", duration, slide).alias("w"), *by)
                 .agg(F.sum("n").alias("requests"), F.sum("n_5xx").alias("errors")))


def windowed_counts(log: DataFrame, delay: str = "10 minutes", duration: str = "5 minutes",
                    slide: str = "1 minute", by=("http_path",)) -> DataFrame:
    return (sliding_counts(log, delay, duration, slide, by)
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by,
                      "requests", "errors"))


def run_to_parquet(stream: DataFrame, sink: str, checkpoint: str, timeout_s: int | None = None) -> None:
    """Append the stream to Parquet (exactly-once file sink) until all input is processed."""
    q = (stream.writeStream.format("parquet").outputMode("append")
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink))
    finish(q, timeout_s)
