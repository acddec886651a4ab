"""Queries of the alert life (R5, O11, O12): stored evaluations, the same live, and notification groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import alerts as AL
from ..session import work_path
from ..streaming.alert_life import run_alert_life
from . import standins as S
from .queries import register
from .stream_queries import WATERMARK, events_stream

#: The request log's labels: three replicas of the service deal the requests among them.
LABELS = ("namespace", "pod")


def with_labels(log, number: str):
    return log.withColumns({"namespace": F.lit("churn"), "pod": F.concat(F.lit("pod-"), (F.col(number) % 3).cast("string"))})


# gaps and islands over the instants at which the error ratio of a replica exceeds 5 %
_RUNS_SQL = f"""
e AS (SELECT 'churn' AS namespace, 'pod-' || (request_seq % 3) AS pod, time_bucket(INTERVAL '1 minute', ts) + to_minutes(k) AS moment,
             count(*) AS requests, count(*) FILTER (WHERE status_code >= 500) AS errors
      FROM ({S.REQUEST_LOG_SQL}) l CROSS JOIN (SELECT unnest(range(1, 6)) AS k) GROUP BY ALL),
h AS (SELECT namespace, pod, moment, lag(moment) OVER (PARTITION BY namespace, pod ORDER BY moment) AS before FROM e WHERE errors / requests > 0.05),
n AS (SELECT *, count(*) FILTER (before IS NULL OR moment - before > INTERVAL '1 minute') OVER w AS run,
             count(*) FILTER (before IS NULL OR moment - before > INTERVAL '5 minutes') OVER w AS episode
      FROM h WINDOW w AS (PARTITION BY namespace, pod ORDER BY moment)),
r AS (SELECT namespace, pod, episode, run, min(moment) AS first_at, max(moment) AS last_at FROM n GROUP BY ALL),
f AS (SELECT namespace, pod, episode, min(run) AS firing_run FROM r WHERE last_at - first_at >= INTERVAL '5 minutes' GROUP BY ALL),
ends AS (SELECT namespace, pod, episode, max(last_at) + INTERVAL '5 minutes' AS resolved_at FROM r GROUP BY ALL),
j AS (SELECT r.*, firing_run, resolved_at FROM r JOIN ends USING (namespace, pod, episode) LEFT JOIN f USING (namespace, pod, episode))"""
TRANSITIONS_SQL = f"""
WITH {_RUNS_SQL}
SELECT 'HighErrorRate' AS alertname, namespace, pod, state, moment AS "at" FROM (
  SELECT namespace, pod, 'pending' AS state, first_at AS moment FROM j WHERE firing_run IS NULL OR run <= firing_run
  UNION ALL SELECT namespace, pod, 'inactive', last_at + INTERVAL '1 minute' FROM j WHERE firing_run IS NULL OR run < firing_run
  UNION ALL SELECT namespace, pod, 'firing', first_at + INTERVAL '5 minutes' FROM j WHERE run = firing_run
  UNION ALL SELECT namespace, pod, 'resolved', resolved_at FROM j WHERE run = firing_run) s"""


def _evaluated(spark, d):
    log = S.request_log(spark, d)
    return AL.evaluations(with_labels(log, "request_seq"), LABELS), log.agg(F.max("ts")).first()[0]


@register("alert_transitions", f"SELECT * FROM ({TRANSITIONS_SQL}) t WHERE \"at\" <= (SELECT max(ts) FROM events)")
def q_alert_transitions(spark, d):
    evaluated, until = _evaluated(spark, d)
    return AL.alert_transitions(evaluated, AL.too_many_errors(), LABELS, until=F.lit(until))


@register("alert_life_stream", f"""
SELECT * FROM ({TRANSITIONS_SQL}) t WHERE "at" < (SELECT max(ts) FROM events) - INTERVAL '{WATERMARK}'""")
def q_alert_life_stream(spark, d):
    """The same from the log as a stream, up to its final watermark."""
    root = work_path(spark, "alert_life")
    run_alert_life(spark, with_labels(events_stream(spark, d), "event_id"), f"{root}/out", f"{root}/_checkpoint", LABELS, delay=WATERMARK)
    return spark.read.parquet(f"{root}/out").withColumn("at", F.col("at").cast("timestamp_ntz"))


@register("alert_notifications", f"""
WITH {_RUNS_SQL},
s AS (SELECT namespace, pod, first_at + INTERVAL '5 minutes' AS firing_at,
             CASE WHEN resolved_at <= (SELECT max(ts) FROM events) THEN resolved_at END AS resolved_at
      FROM j WHERE run = firing_run AND first_at + INTERVAL '5 minutes' <= (SELECT max(ts) FROM events))
SELECT 'HighErrorRate' AS alertname, namespace, time_bucket(INTERVAL '1 day', firing_at) AS period, string_agg(DISTINCT pod, ',' ORDER BY pod) AS members,
       count(*) AS fired, min(firing_at) AS first_firing, max(resolved_at) AS last_resolved, count(*) FILTER (resolved_at IS NULL) AS still_firing
FROM s GROUP BY ALL""")
def q_alert_notifications(spark, d):
    evaluated, until = _evaluated(spark, d)
    groups = AL.notification_groups(AL.alert_spans(evaluated, AL.too_many_errors(), LABELS, until=F.lit(until)), "pod")
    return groups.withColumn("members", F.array_join("members", ","))
