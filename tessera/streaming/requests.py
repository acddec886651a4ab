"""The two kinds of a request's log lines joined on a stream (O1).

A request line waits for its ``prediction_returned`` line, as either may be written first or delivered late: a
stream-stream left outer join by request id, within ``within`` of each other.  A pair is emitted when its second line comes; a
request without an answer once the watermark has passed the time at which one could still come.  Repeated
prediction lines of an id are dropped within the watermark, so a client that repeats an id, or a shipper that
sends a line twice, multiplies no rows.  A request without an id is emitted as unanswered.

State is bounded by the traffic of ``delay + within``, in RocksDB.  Keys are request ids, so no key is hot; requests
without an id never enter the join, in which they would share one key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ops import REQUEST_EVENTS, parse_log
from .runner import finish, rocksdb_state

KEEP = ("http_method", "http_path", "duration_ms")
_ANSWER = ("predicted_class", "probability")


def answered_requests(lines: DataFrame, delay: str = "10 minutes", within: str = "5 minutes", keep=KEEP) -> DataFrame:
    """Log lines (``value``) to one row per request line: request_id, ``keep``, ts, status_code, predicted_class, probability."""
    parsed = parse_log(lines).withColumn("ts", F.col("ts").cast("timestamp"))
    status = F.when(F.col("event") == "request_failed", F.lit(500)).otherwise(F.col("status_code")).alias("status_code")
    requests = parsed.filter(F.col("event").isin(*REQUEST_EVENTS)).withWatermark("ts", delay).select("request_id", *keep, "ts", status)
    answers = (parsed.filter((F.col("event") == "prediction_returned") & F.col("request_id").isNotNull())
               .select(F.col("request_id").alias("answer_id"), F.col("ts").alias("answered_at"), *_ANSWER)
               .withWatermark("answered_at", delay).dropDuplicatesWithinWatermark(["answer_id"]))
    near = F.expr(f"answered_at BETWEEN ts - INTERVAL {within} AND ts + INTERVAL {within}")
    joined = requests.filter("request_id IS NOT NULL").join(answers, (F.col("request_id") == F.col("answer_id")) & near, "left")
    nameless = requests.filter("request_id IS NULL").withColumns({"predicted_class": F.lit(None).cast("int"), "probability": F.lit(None).cast("double")})
    return joined.drop("answer_id", "answered_at").unionByName(nameless)


def run_answered_requests(spark: SparkSession, lines: DataFrame, sink: str, checkpoint: str, delay: str = "10 minutes",
                          within: str = "5 minutes", timeout_s: int | None = None) -> None:
    with rocksdb_state(spark):
        q = (answered_requests(lines, delay, within).writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink))
        finish(q, timeout_s)
