"""Streaming queries (C5, R4) and previews / schema checks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..operators import quality as QA
from ..session import work_path
from ..streaming.alerts import run_alert_stream
from ..streaming.ops import run_to_parquet, windowed_counts
from ..streaming.requests import run_answered_requests
from ..streaming.scoring import run_scoring_stream
from . import standins as S
from .model_queries import _CHECKED_SQL, _envelope_sql, _records
from .queries import (ALERT_SQL, GOLD_DOUBLES, GOLD_SQL, LOG_PREDICTIONS_SQL, ROUND, gold_churn, log_lines, register, round6,
                      rounded)

WATERMARK = "10 minutes"


@register("score_stream", _envelope_sql(f"SELECT * FROM ({_CHECKED_SQL}) c WHERE len(_errors) = 0"))
def q_score_stream(spark, d):
    root = work_path(spark, "score_stream")
    _records(spark, d).write.parquet(f"{root}/records")
    schema = spark.read.parquet(f"{root}/records").schema
    run_scoring_stream(spark, f"{root}/records", schema, f"{root}/out", f"{root}/_checkpoint",
                       C.ID_COLUMN, max_files_per_trigger=2)
    return spark.read.parquet(f"{root}/out/scored").drop("batch")


def events_stream(spark, d):
    from ..sources.tables import list_dirs

    ev_schema = S.table(spark, d, "events").schema
    base = d.rstrip("/")
    if "events.parquet" in list_dirs(spark, base):        # a folder of part files
        events = spark.readStream.schema(ev_schema).parquet(f"{base}/events.parquet")
    else:
        # one file: the file source lists a folder, the glob filter keeps that file
        events = spark.readStream.schema(ev_schema).option("pathGlobFilter", "events.parquet").parquet(base)
    return events.select(
        "event_id", F.col("ts"), F.concat(F.lit("/"), F.col("event_type")).alias("http_path"),
        F.when(F.col("event_type") == "error", F.lit(500)).otherwise(F.lit(200)).alias("status_code"))


@register("ops_stream_windows", f"""
WITH l AS ({S.REQUEST_LOG_SQL}),
w AS (SELECT l.*, time_bucket(INTERVAL '1 minute', ts) - to_minutes(t.k) AS window_start
      FROM l CROSS JOIN (SELECT range AS k FROM range(5)) t)
SELECT window_start, window_start + INTERVAL '5 minutes' AS window_end, http_path,
       count(*) AS requests, count(*) FILTER (WHERE status_code >= 500) AS errors
FROM w GROUP BY ALL
HAVING window_start + INTERVAL '5 minutes' <= (SELECT max(ts) FROM events) - INTERVAL '{WATERMARK}'""")
def q_ops_stream_windows(spark, d):
    """Closed windows only: the append stream holds back windows the final
    watermark (max event time - delay) has not passed yet."""
    root = work_path(spark, "ops_stream")
    log = events_stream(spark, d)
    run_to_parquet(windowed_counts(log, WATERMARK), f"{root}/out", f"{root}/_checkpoint")
    out = spark.read.parquet(f"{root}/out")
    # back to the input's timestamp_ntz so both sides compare wall-clock values
    return out.withColumns({"window_start": F.col("window_start").cast("timestamp_ntz"),
                            "window_end": F.col("window_end").cast("timestamp_ntz")})


@register("error_alert_stream", f"""
SELECT alertname, fires_at FROM ({ALERT_SQL}) a
WHERE fires_at <= (SELECT max(ts) FROM events) - INTERVAL '{WATERMARK}'""")
def q_error_alert_stream(spark, d):
    """The held alert as a stateful stream; instants up to the final watermark."""
    root = work_path(spark, "alert_stream")
    run_alert_stream(spark, events_stream(spark, d), f"{root}/out", f"{root}/_checkpoint")
    out = spark.read.parquet(f"{root}/out")
    return out.select("alertname", F.col("fires_at").cast("timestamp_ntz").alias("fires_at"))


@register("log_predictions_stream", f"""
SELECT * FROM ({LOG_PREDICTIONS_SQL}) l
WHERE predicted_class IS NOT NULL OR ts + INTERVAL '5 minutes' < (SELECT max(ts) FROM events) - INTERVAL '{WATERMARK}'""")
def q_log_predictions_stream(spark, d):
    """The log as a stream of text files: answered requests, and unanswered ones up to the final watermark."""
    root = work_path(spark, "request_stream")
    log_lines(spark, d).select("value").write.text(f"{root}/log")
    run_answered_requests(spark, spark.readStream.text(f"{root}/log"), f"{root}/out", f"{root}/_checkpoint", WATERMARK, "5 minutes")
    out = spark.read.parquet(f"{root}/out")
    return out.select("request_id", "http_path", "status_code", "duration_ms", F.col("ts").cast("timestamp_ntz").alias("ts"), "predicted_class",
                      round6("probability").alias("probability"))


@register("preview_limit", f"""
SELECT * REPLACE ({", ".join(f"round({c}, {ROUND}) AS {c}" for c in GOLD_DOUBLES)})
FROM ({GOLD_SQL}) g ORDER BY customer_id LIMIT 10""")
def q_preview_limit(spark, d):
    """``display(df.limit(n))`` with a total order, so the preview is reproducible."""
    return rounded(gold_churn(spark, d)).orderBy(C.ID_COLUMN).limit(10)


def gold_contract() -> T.StructType:
    ints = {"senior_citizen", "partner", "dependents", "tenure_months", "phone_service", "paperless_billing",
            "churn", "is_long_tenure", "is_high_spender", "gender_male"} | set(C.CONTRACT_DEFAULTED_FLAGS)
    fields = [T.StructField(C.ID_COLUMN, T.StringType())]
    order = ["senior_citizen", "partner", "dependents", "tenure_months", "phone_service", "paperless_billing",
             "monthly_charges", "total_charges", "churn", "avg_charge_per_month", "is_long_tenure",
             "is_high_spender", "gender_male", *C.CONTRACT_DEFAULTED_FLAGS]
    for n in order:
        fields.append(T.StructField(n, T.IntegerType() if n in ints else T.DoubleType()))
    fields.append(T.StructField("_split", T.StringType()))
    return T.StructType(fields)


def _schema_rows_sql() -> str:
    def of(i, f):
        numeric = f.dataType != T.StringType()
        low, high = (f"round({x}({f.name})::DOUBLE, {ROUND})" if numeric else "NULL::DOUBLE" for x in ("min", "max"))
        return (f"SELECT {i} AS position, '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS type, "
                f"count(*) - count({f.name}) AS nulls, {low} AS low, {high} AS high FROM g")

    return f"WITH g AS ({GOLD_SQL}) " + " UNION ALL ".join(of(i, f) for i, f in enumerate(gold_contract().fields))


@register("schema_check", _schema_rows_sql())
def q_schema_check(spark, d):
    """Gold against its declared contract (S19, S21): one row per column with its type, NULLs and range, one pass."""
    g = gold_churn(spark, d)
    QA.assert_schema(g, gold_contract())
    return rounded(QA.column_profile(g, gold_contract().names))


@register("catalog_setup", f"""
SELECT 'churn_gold' AS schema_name, 'customer_churn_features' AS table_name, _split, count(*) AS n_rows
FROM ({GOLD_SQL}) g GROUP BY _split""")
def q_catalog_setup(spark, d):
    """Layer schemas (S14) and the Gold table registered in the gold layer, read back by name."""
    from ..sources.tables import create_layers, register_table

    layers = create_layers(spark, "churn").select("schema_name").collect()   # four names
    assert len(layers) == 4
    path = work_path(spark, "catalog", "customer_churn_features")
    gold_churn(spark, d).write.partitionBy("_split").parquet(path)
    name = register_table(spark, "churn_gold", "customer_churn_features", path)
    return (spark.table(name).groupBy("_split").agg(F.count(F.lit(1)).alias("n_rows"))
                 .select(F.lit("churn_gold").alias("schema_name"),
                         F.lit("customer_churn_features").alias("table_name"), "_split", "n_rows"))
