"""Queries of the stored rollups (long trailing windows at a short step, quantiles and distinct keys from sketches) and of the
learned vocabulary."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rollups as RO
from ..operators import vocabulary as VO
from ..operators.ops import is_5xx
from ..session import work_path
from . import standins as S
from .queries import r, register, rounded


@register("error_budget_30s", f"""
WITH s AS (SELECT time_bucket(INTERVAL '30 seconds', ts) AS b, count(*) AS n, count(*) FILTER (WHERE status_code < 500) AS ok
           FROM ({S.REQUEST_LOG_SQL}) l GROUP BY 1),
g AS (SELECT unnest(generate_series((SELECT min(b) FROM s), (SELECT max(b) FROM s), INTERVAL '30 seconds')) AS b),
w AS (SELECT g.b, sum(coalesce(n, 0)) OVER w AS requests, sum(coalesce(ok, 0)) OVER w AS ok_requests
      FROM g LEFT JOIN s USING (b) WINDOW w AS (ORDER BY g.b RANGE BETWEEN INTERVAL '86370 seconds' PRECEDING AND CURRENT ROW))
SELECT b + INTERVAL '30 seconds' - INTERVAL '24 hours' AS window_start, b + INTERVAL '30 seconds' AS window_end, requests::BIGINT AS requests,
       ok_requests::BIGINT AS ok_requests, {r('1 - ok_requests::BIGINT / requests::BIGINT', 'budget_consumed')}
FROM w WHERE requests > 0""")
def q_error_budget_30s(spark, d):
    """The 24 h error budget (O9) at the dashboard's refresh of 30 seconds."""
    out = RO.trailing_sums(S.request_log(spark, d), {"requests": F.count(F.lit(1)), "ok_requests": F.count_if(~is_5xx())})
    return rounded(out.withColumn("budget_consumed", 1 - F.col("ok_requests") / F.col("requests")))


def _stored(spark, d):
    log = S.table(spark, d, "events").select("ts", "event_type", "user_id", (F.col("value") / 1000).alias("duration_s"))
    path = f"{work_path(spark, 'sketches')}/steps"
    RO.step_sketches(log, "duration_s", "user_id", ("event_type",)).write.parquet(path)
    return log, spark.read.parquet(path)


#: KLL with k = 200: a quantile's rank is off by less than 1.65 % of the values; HyperLogLog with 2^12 registers: three deviations.
RANK_BOUND, DISTINCT_BOUND = 0.0165, 3 * 1.04 / 2 ** 6


@register("duration_quantile_sketch", """
SELECT time_bucket(INTERVAL '1 day', ts) AS span_start, event_type, count(value) AS observations, 1 AS p50_ok, 1 AS p95_ok, 1 AS p99_ok
FROM events GROUP BY ALL""")
def q_duration_quantile_sketch(spark, d):
    """Daily quantiles of raw durations from stored minute sketches; the rank of each among the raw rows is within the bound."""
    log, sketches = _stored(spark, d)
    found = RO.span_quantiles(sketches, (0.5, 0.95, 0.99), ("event_type",))
    rows = log.select(F.window("ts", "1 day").start.alias("span_start"), "event_type", "duration_s").join(found, ["span_start", "event_type"])

    def near(q: float, column: str):
        below, upto = (F.count_if(c) / F.first("observations") for c in (F.col("duration_s") < F.col(column), F.col("duration_s") <= F.col(column)))
        slack = RANK_BOUND + 1 / F.first("observations")
        return ((below <= q + slack) & (upto >= q - slack)).cast("int").alias(f"{column}_ok")

    checked = rows.groupBy("span_start", "event_type").agg(F.first("observations").alias("observations"),
                                                           *[near(q, c) for q, c in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99"))])
    return checked


@register("distinct_users_sketch", """
SELECT time_bucket(INTERVAL '1 day', ts) AS span_start, event_type, count(DISTINCT user_id) AS exact_keys, 1 AS estimate_ok
FROM events GROUP BY ALL""")
def q_distinct_users_sketch(spark, d):
    """Distinct users a day from stored minute sketches beside the exact count (A3)."""
    log, sketches = _stored(spark, d)
    exact = log.groupBy(F.window("ts", "1 day").start.alias("span_start"), "event_type").agg(F.count_distinct("user_id").alias("exact_keys"))
    near = F.abs(F.col("distinct_keys") - F.col("exact_keys")) <= F.greatest(F.lit(1.0), F.lit(DISTINCT_BOUND) * F.col("exact_keys"))
    return (exact.join(RO.span_distinct(sketches, ("event_type",)), ["span_start", "event_type"])
            .select("span_start", "event_type", "exact_keys", near.cast("int").alias("estimate_ok")))


@register("learned_vocabulary", """
WITH n AS (SELECT c_custkey, lower(trim(c_mktsegment)) AS v FROM customer),
k AS (SELECT v, row_number() OVER (ORDER BY count(*) DESC, v) AS position FROM n WHERE c_custkey % 2 = 0 AND v IS NOT NULL GROUP BY v)
SELECT n.c_custkey, CAST(coalesce(position = 1, false) AS INTEGER) AS c_mktsegment_1, CAST(coalesce(position = 2, false) AS INTEGER) AS c_mktsegment_2,
       CAST(coalesce(position = 3, false) AS INTEGER) AS c_mktsegment_3, CAST(n.v IS NOT NULL AND coalesce(position, 4) > 3 AS INTEGER) AS c_mktsegment_unseen
FROM n LEFT JOIN k USING (v) WHERE c_custkey % 2 = 1""")
def q_learned_vocabulary(spark, d):
    """Three segments learned from customers of even keys, stored, read back, and used on the others."""
    customers = S.table(spark, d, "customer")
    path = work_path(spark, "vocabulary")
    VO.save_vocabulary(VO.fit_vocabulary(customers.filter("c_custkey % 2 = 0"), ["c_mktsegment"], most=3), path)
    return customers.filter("c_custkey % 2 = 1").select("c_custkey", *VO.encoded(VO.load_vocabulary(spark, path)))
