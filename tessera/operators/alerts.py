"""The life of an alert (R5, O11, O12): pending, firing, resolved, and how firing alerts are grouped for notification.

An alert is a name and a set of labels; its rule is evaluated at instants a ``step`` apart.  The
condition holds at some of them.  A missing evaluation counts as one at which it does not hold.

* pending   from the first instant at which it holds, while it holds at every further one
* inactive  when it stops holding before it has held for ``hold``
* firing    once it has held for ``hold``; from then on gaps of up to ``resolve`` do not end it
* resolved  ``resolve`` after the last instant at which it held

Here for stored evaluations, as gaps and islands; ``streaming.alert_life`` gives the same transitions
live.  A label set's instants are ordered in one task: they are bounded by the clock (half a million a year at one a minute), not
by the traffic, which is counted per window before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from .ops import _seconds, is_5xx, sliding_sums


def _after(instant, seconds: int) -> Column:
    return (F.col(instant) if isinstance(instant, str) else instant) + F.make_dt_interval(secs=F.lit(seconds))


def evaluations(log: DataFrame, labels=(), duration: str = "5 minutes", step: str = "1 minute") -> DataFrame:
    """One row per label set and instant with traffic in the trailing ``duration``: labels, at, requests, errors."""
    found = sliding_sums(log, {"requests": F.count(F.lit(1)), "errors": F.count_if(is_5xx())}, tuple(labels), duration, step)
    return found.select(*labels, F.col("window_end").alias("at"), "requests", "errors")


def too_many_errors(threshold: float = C.ERROR_RATIO_RED) -> Column:
    return F.col("errors") / F.col("requests") > threshold


def _runs(held_at: DataFrame, labels, resolve: int, step: int) -> DataFrame:
    """Runs of instants a step apart, numbered within episodes, which gaps of more than ``resolve`` seconds part."""
    order = Window.partitionBy(*labels).orderBy("at")
    before = F.lag("at").over(order)
    marked = held_at.select(*labels, "at", (before.isNull() | (F.col("at") > _after(before, step))).cast("int").alias("starts_run"),
                            (before.isNull() | (F.col("at") > _after(before, resolve))).cast("int").alias("starts_episode"))
    numbered = marked.select(*labels, "at", F.sum("starts_run").over(order).alias("run"), F.sum("starts_episode").over(order).alias("episode"))
    return numbered.groupBy(*labels, "episode", "run").agg(F.min("at").alias("first"), F.max("at").alias("last"))


def _episodes(evaluated: DataFrame, condition: Column, labels, hold: str, resolve: str, step: str) -> DataFrame:
    """One row per run, with its episode's firing run (null if none), firing instant and last instant."""
    step_s = _seconds(step)
    hold_s = -(-_seconds(hold) // step_s) * step_s
    held_at = evaluated.filter(F.coalesce(condition, F.lit(False))).select(*labels, "at")
    runs = _runs(held_at, labels, _seconds(resolve), step_s)
    whole = Window.partitionBy(*labels, "episode")
    fires = F.when(F.col("last") >= _after("first", hold_s), F.struct("run", _after("first", hold_s).alias("at")))
    runs = runs.withColumn("fired", F.min(fires).over(whole)).withColumn("episode_last", F.max("last").over(whole))
    return runs.select(*labels, "episode", "run", "first", "last", "episode_last", F.col("fired.run").alias("firing_run"), F.col("fired.at").alias("firing_at"))


def alert_transitions(evaluated: DataFrame, condition: Column, labels=(), name: str = "HighErrorRate", hold: str = "5 minutes",
                      resolve: str = "5 minutes", step: str = "1 minute", until=None) -> DataFrame:
    """alertname, labels, state, at: every change of state, those after ``until`` left out."""
    runs = _episodes(evaluated, condition, labels, hold, resolve, step)
    before_firing = F.col("firing_run").isNull() | (F.col("run") < F.col("firing_run"))
    firing = F.col("run") == F.col("firing_run")
    steps = F.array(*[F.struct(F.lit(state).alias("state"), F.when(when, at).alias("at")) for state, when, at in (
        ("pending", before_firing | firing, F.col("first")), ("inactive", before_firing, _after("last", _seconds(step))),
        ("firing", firing, F.col("firing_at")), ("resolved", firing, _after("episode_last", _seconds(resolve))))])
    out = runs.select(F.lit(name).alias("alertname"), *labels, F.explode(steps).alias("s")).select("alertname", *labels, "s.state", "s.at")
    return out.filter(F.col("at").isNotNull() if until is None else F.col("at") <= until)


def alert_spans(evaluated: DataFrame, condition: Column, labels=(), name: str = "HighErrorRate", hold: str = "5 minutes",
                resolve: str = "5 minutes", step: str = "1 minute", until=None) -> DataFrame:
    """alertname, labels, pending_at, firing_at, resolved_at (null if it still fires at ``until``): one row per time that it fired."""
    runs = _episodes(evaluated, condition, labels, hold, resolve, step).filter(F.col("run") == F.col("firing_run"))
    resolved = _after("episode_last", _seconds(resolve))
    if until is not None:
        runs, resolved = runs.filter(F.col("firing_at") <= until), F.when(resolved <= until, resolved)
    return runs.select(F.lit(name).alias("alertname"), *labels, F.col("first").alias("pending_at"), "firing_at", resolved.alias("resolved_at"))


def notification_groups(spans: DataFrame, member: str, by=("alertname", "namespace"), period: str = "1 day") -> DataFrame:
    """Firing alerts as the notification router groups them (O12): per group and period of firing its members (distinct values of
    the label ``member``), how often they fired, the span of it all and whether any still fires.

    Spans are first merged per member, so a group collects one entry per member."""
    start = F.window("firing_at", period).start
    each = spans.groupBy(*by, start.alias("period"), member).agg(
        F.count(F.lit(1)).alias("fired"), F.min("firing_at").alias("first_firing"), F.max("resolved_at").alias("last_resolved"),
        F.count_if(F.col("resolved_at").isNull()).alias("open"))
    return each.groupBy(*by, "period").agg(
        F.sort_array(F.collect_list(member)).alias("members"), F.sum("fired").alias("fired"), F.min("first_firing").alias("first_firing"),
        F.max("last_resolved").alias("last_resolved"), F.sum("open").alias("still_firing"))
