"""Operational rollups over the scoring service's request log.

The dashboard queries were PromQL over scraped counters; here they are
computed exactly from the raw request rows:

* rates -- event-time windows (``window(ts, 5 min, 1 min)`` by default),
  count / window seconds;
* latency quantiles -- cumulative ``le`` bucket counts in the same
  aggregation (one ``count_if`` per bound, partial-then-final), then the
  ``histogram_quantile`` interpolation as a CASE expression on the
  aggregated row (no explode, no window, no Python);
* held alerts -- every window whose condition holds "votes" for the
  evaluation instants it covers; an instant fires when all the evaluations
  of the hold period voted.  A plain aggregation: no global ordering, so no
  single task sees the whole series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C


def le_labels(bounds) -> list[str]:
    """Bucket labels as the metrics exposition writes them, plus ``+Inf``."""
    return [repr(float(b)) for b in bounds] + ["+Inf"]


def label_match(col, pattern: str) -> Column:
    """PromQL ``label=~"pattern"``: the regex must match the whole value."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string").rlike(f"^(?:{pattern})$")


def is_5xx(status: str = "status_code") -> Column:
    return label_match(status, "5..")


def windowed(df: DataFrame, ts: str = "ts", duration: str = "5 minutes",
             slide: str | None = "1 minute") -> DataFrame:
    """Attach the event-time window(s) of every row as ``window_start/window_end``."""
    w = F.window(ts, duration, slide) if slide else F.window(ts, duration)
    return df.withColumn("_w", w).withColumns(
        {"window_start": F.col("_w.start"), "window_end": F.col("_w.end")}).drop("_w")


def _seconds(duration: str) -> int:
    n, unit = duration.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def sliding_sums(log: DataFrame, sums: dict, by=(), duration: str = "5 minutes",
                 slide: str | None = "1 minute", ts: str = "ts") -> DataFrame:
    """Additive aggregates over sliding event-time windows, pre-aggregated per slide.

    Raw rows are aggregated once per (slide bucket, labels) -- a partial /
    final hash aggregation with no row expansion; only those bucket rows
    are fanned out to the ``duration / slide`` windows that contain them
    and summed again.  Equal to ``groupBy(window(ts, duration, slide))``
    for counts, sums and bucket counts, at a fraction of the work on the
    raw rows.  ``slide=None`` gives tumbling windows.
    """
    if slide is None:
        agg = windowed(log, ts, duration, None).groupBy("window_start", "window_end", *by)
        return agg.agg(*[c.alias(n) for n, c in sums.items()])
    n = _seconds(duration) // _seconds(slide)
    if n * _seconds(slide) != _seconds(duration):
        raise ValueError("duration must be a multiple of slide")
    step = _seconds(slide)
    per_slide = (log.groupBy(F.window(ts, slide).start.alias("_b"), *by)
                    .agg(*[c.alias(n_) for n_, c in sums.items()]))
    starts = F.array(*[F.col("_b") - F.make_dt_interval(secs=F.lit(k * step)) for k in range(n)])
    fanned = per_slide.select(*by, *sums, F.explode(starts).alias("window_start"))
    return (fanned.groupBy("window_start", *by).agg(*[F.sum(c).alias(c) for c in sums])
                  .withColumn("window_end", F.col("window_start") + F.make_dt_interval(secs=F.lit(_seconds(duration))))
                  .select("window_start", "window_end", *by, *sums))


def request_rate(log: DataFrame, by=(), duration: str = "5 minutes", slide: str | None = "1 minute",
                 per: str = "second") -> DataFrame:
    """Requests per second (or per minute) over sliding windows, optionally by labels."""
    secs = _seconds(duration) / (60 if per == "minute" else 1)
    return (sliding_sums(log, {"requests": F.count(F.lit(1))}, by, duration, slide)
            .withColumn(f"per_{per}", F.col("requests") / F.lit(float(secs))))


def error_ratio(log: DataFrame, duration: str = "5 minutes", slide: str | None = "1 minute",
                yellow: float = C.ERROR_RATIO_YELLOW, red: float = C.ERROR_RATIO_RED) -> DataFrame:
    """5xx share of requests per window with the dashboard's colour band."""
    agg = sliding_sums(log, {"requests": F.count(F.lit(1)), "errors": F.count_if(is_5xx())},
                       (), duration, slide)
    ratio = F.col("errors") / F.col("requests")
    return agg.withColumns({
        "error_ratio": ratio,
        "band": F.when(ratio >= red, F.lit("red")).when(ratio >= yellow, F.lit("yellow")).otherwise(F.lit("green")),
    })


def error_budget(log: DataFrame, duration: str = "24 hours", slide: str = "1 hour") -> DataFrame:
    """``1 - non-5xx / all`` over the trailing ``duration``, evaluated every ``slide``."""
    agg = sliding_sums(log, {"requests": F.count(F.lit(1)), "ok_requests": F.count_if(~is_5xx())},
                       (), duration, slide)
    return agg.withColumn("budget_consumed", 1 - F.col("ok_requests") / F.col("requests"))


def predictions(log: DataFrame, cls: str = "predicted_class") -> DataFrame:
    """The requests that gave a prediction; a failed one has no class."""
    return log.filter(F.col(cls).isNotNull())


def class_distribution(log: DataFrame, cls: str = "predicted_class", duration: str = "5 minutes",
                       slide: str | None = "1 minute") -> DataFrame:
    """Predictions per class and window with each class's share of the window."""
    agg = sliding_sums(predictions(log, cls), {"predictions": F.count(F.lit(1))}, (cls,), duration, slide)
    # a window holds one row per class, so this partition is tiny
    tot = F.sum("predictions").over(Window.partitionBy("window_start", "window_end"))
    return agg.withColumn("share", F.col("predictions") / tot)


def request_counters(log: DataFrame) -> DataFrame:
    """Labelled counters: requests by (method, path, status)."""
    return log.groupBy("http_method", "http_path", "status_code").agg(F.count(F.lit(1)).alias("requests"))


# ---------------------------------------------------------------------------
# Histograms and quantiles
# ---------------------------------------------------------------------------

def bucket_aggs(value: str, bounds) -> list[Column]:
    """Cumulative bucket counts, total count and sum of one observed value."""
    v = F.col(value)
    return ([F.count_if(v <= F.lit(float(b))).alias(f"_le{i}") for i, b in enumerate(bounds)]
            + [F.count(v).alias("_count"), F.sum(v).alias("_sum")])


def histogram_quantile(q: float, bounds, cums, total: Column) -> Column:
    """Prometheus ``histogram_quantile`` on cumulative counts of the finite buckets.

    rank = q * total; first bucket whose count reaches rank; linear
    interpolation inside it (lowest bucket starts at 0); rank in the +Inf
    bucket -> largest finite bound; no observations -> NaN.
    """
    rank = F.lit(float(q)) * total
    # one codegen'd CASE over the cumulative columns: the first whose count reaches the rank
    out = F.when(total == 0, F.lit(float("nan")))
    start, prev = F.lit(0.0), F.lit(0)
    for bound, cur in zip(bounds, cums, strict=True):
        end = F.lit(float(bound))
        out = out.when(cur >= rank, start + (end - start) * (rank - prev) / (cur - prev))
        start, prev = end, cur
    return out.otherwise(F.lit(float(bounds[-1])))


def latency_histogram(log: DataFrame, value: str = "duration_s", by=("http_method", "http_path"),
                      bounds=C.LATENCY_BUCKETS) -> DataFrame:
    """Cumulative ``le`` buckets, sum and count per label set, in long form (A10)."""
    agg = log.groupBy(*by).agg(*bucket_aggs(value, bounds))
    labels = le_labels(bounds)
    entries = F.array(*[F.struct(F.lit(labels[i]).alias("le"), F.col(f"_le{i}").alias("cumulative_count"))
                        for i in range(len(bounds))]
                      + [F.struct(F.lit("+Inf").alias("le"), F.col("_count").alias("cumulative_count"))])
    return agg.select(*by, F.col("_sum").alias("sum_seconds"), F.col("_count").alias("count"),
                      F.inline(entries))


def latency_quantiles(log: DataFrame, value: str = "duration_s", quantiles=(0.5, 0.95, 0.99),
                      bounds=C.LATENCY_BUCKETS, by=(), duration: str | None = "5 minutes",
                      slide: str | None = "1 minute") -> DataFrame:
    """p50/p95/p99 per window (and labels) from histogram buckets."""
    keys = (["window_start", "window_end"] if duration else []) + list(by)
    if duration:
        sums = {f"_le{i}": F.count_if(F.col(value) <= F.lit(float(b))) for i, b in enumerate(bounds)}
        sums.update({"_count": F.count(F.col(value)), "_sum": F.sum(F.col(value))})
        agg = sliding_sums(log, sums, by, duration, slide)
    else:
        agg = log.groupBy(*keys).agg(*bucket_aggs(value, bounds))
    cums = [F.col(f"_le{i}") for i in range(len(bounds))]
    return agg.select(*keys, F.col("_count").alias("observations"),
                      *[histogram_quantile(q, bounds, cums, F.col("_count")).alias(f"p{int(round(q * 100))}")
                        for q in quantiles])


def raw_latency_quantiles(log: DataFrame, value: str = "duration_s", quantiles=(0.5, 0.95, 0.99),
                          by=(), duration: str | None = "5 minutes", slide: str | None = "1 minute",
                          accuracy: int = 10000) -> DataFrame:
    """Variant of O6 on the raw durations: ``percentile_approx`` per window
    (mergeable sketches, partial then final), no bucket interpolation."""
    src = windowed(log, "ts", duration, slide) if duration else log
    keys = (["window_start", "window_end"] if duration else []) + list(by)
    pct = F.percentile_approx(F.col(value), list(quantiles), accuracy)
    agg = src.groupBy(*keys).agg(F.count(F.col(value)).alias("observations"), pct.alias("_q"))
    return agg.select(*keys, "observations", *[F.col("_q")[i].alias(f"p{int(round(q * 100))}")
                                               for i, q in enumerate(quantiles)])


def slowest_endpoints(log: DataFrame, k: int = 5, q: float = 0.99, duration: str = "5 minutes",
                      value: str = "duration_s", bounds=C.LATENCY_BUCKETS, slide: str | None = "1 minute") -> DataFrame:
    """Top-k paths by quantile latency per trailing window."""
    qs = latency_quantiles(log, value, (q,), bounds, ("http_path",), duration, slide)
    col = f"p{int(round(q * 100))}"
    # one row per path and window: the ranking partition is as small as the path set
    w = Window.partitionBy("window_start", "window_end").orderBy(F.col(col).desc(), F.col("http_path"))
    return qs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


# ---------------------------------------------------------------------------
# Alerts (O11, O12, R5)
# ---------------------------------------------------------------------------

def held_alert(cond_windows: DataFrame, cond: Column, hold: str = "5 minutes", step: str = "1 minute",
               name: str = "HighErrorRate", labels: dict | None = None) -> DataFrame:
    """Instants at which ``cond`` has held at every evaluation of the last ``hold``.

    ``cond_windows`` has one row per evaluation instant (``window_end``).
    Each true evaluation votes for itself and the next ``hold/step``
    instants; an instant with all votes fires.
    """
    n = _seconds(hold) // _seconds(step)
    true_at = cond_windows.filter(F.coalesce(cond, F.lit(False))).select("window_end")
    votes = true_at.select(F.explode(F.array(*[
        F.col("window_end") + F.make_dt_interval(secs=F.lit(k * _seconds(step))) for k in range(n + 1)
    ])).alias("fires_at"))
    fired = votes.groupBy("fires_at").agg(F.count(F.lit(1)).alias("_votes")).filter(F.col("_votes") == n + 1)
    cols = [F.lit(name).alias("alertname")] + [F.lit(v).alias(k) for k, v in (labels or {}).items()]
    return fired.select(*cols, "fires_at")


def error_alert(log: DataFrame, threshold: float = C.ERROR_RATIO_RED, hold: str = "5 minutes",
                namespace: str = "churn") -> DataFrame:
    """HighErrorRate: 5xx ratio over 5 m above ``threshold`` for ``hold``."""
    ratios = error_ratio(log)
    return held_alert(ratios, F.col("error_ratio") > threshold, hold, "1 minute", "HighErrorRate",
                      {"namespace": namespace, "severity": "page"})


def alert_groups(alerts: DataFrame, by=("alertname", "namespace"), period: str = "1 day") -> DataFrame:
    """Firing instants grouped like the notification router (O12): count and span per group and period."""
    return (windowed(alerts, "fires_at", period, None)
            .groupBy(*by, "window_start")
            .agg(F.count(F.lit(1)).alias("firing_instants"),
                 F.min("fires_at").alias("first_firing"), F.max("fires_at").alias("last_firing")))


# ---------------------------------------------------------------------------
# Log lines (O1)
# ---------------------------------------------------------------------------

LOG_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("level", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("request_id", T.StringType()),
    T.StructField("http_method", T.StringType()),
    T.StructField("http_path", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("duration_ms", T.DoubleType()),
    T.StructField("predicted_class", T.IntegerType()),
    T.StructField("probability", T.DoubleType()),
])


def parse_log(lines: DataFrame, value: str = "value", keep=()) -> DataFrame:
    """JSON log lines -> typed columns; unparsable lines keep their text in ``_bad_line``.
    ``ts`` is the UTC wall-clock time as ``timestamp_ntz``."""
    parsed = F.from_json(F.col(value), LOG_SCHEMA, {"mode": "PERMISSIVE"})
    df = lines.withColumn("_p", parsed)
    ok = F.col("_p.timestamp").isNotNull() & F.col("_p.event").isNotNull()
    return df.select(
        *[F.col(k) for k in keep],
        *[F.col(f"_p.{f.name}").alias(f.name) for f in LOG_SCHEMA.fields if f.name != "timestamp"],
        # the service logs UTC ("...Z"): keep the UTC wall clock, whatever the session zone
        F.to_timestamp_ntz(F.regexp_replace(F.col("_p.timestamp"), "Z$", "")).alias("ts"),
        F.when(~ok, F.col(value)).alias("_bad_line"),
    )


REQUEST_EVENTS = ("request_finished", "request_failed")


def request_predictions(parsed: DataFrame, keep=("http_method", "http_path", "duration_ms", "ts")) -> DataFrame:
    """The two kinds of a request's log lines joined by request id: one row per request
    line, with class and probability of its ``prediction_returned`` line (NULL without one).

    A failed request logs no status; it counts as 500, as in the service's counters.
    Of several prediction lines of an id the latest is taken, so a client that repeats
    an id multiplies no rows.  A request without an id, and a prediction line whose
    request line is missing, find no partner.
    """
    requests = parsed.filter(F.col("event").isin(*REQUEST_EVENTS)).select(
        "request_id", *keep,
        F.when(F.col("event") == "request_failed", F.lit(500)).otherwise(F.col("status_code")).alias("status_code"))
    answers = (parsed.filter((F.col("event") == "prediction_returned") & F.col("request_id").isNotNull())
               .groupBy("request_id")
               .agg(F.max(F.struct("ts", "predicted_class", "probability")).alias("_a"))
               .select("request_id", F.col("_a.predicted_class"), F.col("_a.probability")))
    return requests.join(answers, "request_id", "left")
