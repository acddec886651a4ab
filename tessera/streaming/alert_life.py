"""The life of an alert on a stream (R5, O11): ``transformWithState`` with event-time timers, keyed by label set.

Closed evaluation windows come in from the watermarked window aggregation.  An instant at
which the condition holds sets three timers of its label set: for the instant itself, for the step after it, at
which a pending alert drops if the instant was its last, and for the end of the ``resolve`` period, at which a
firing one resolves.  Timers expire in order of event time once the watermark has passed them, so instants may
come in any order, and a batch's history is not sorted in Python.  State is three numbers per label set,
and timers up to ``resolve`` ahead of the watermark.

The timers of one label set differ in their milliseconds: whole ones are instants, the others checks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ..operators.alerts import too_many_errors
from ..operators.ops import _seconds
from .ops import sliding_counts
from .runner import finish, rocksdb_state

_CHECK = 1  # milliseconds after the instant at which a check is due


class AlertLife(StatefulProcessor):
    """(label set, instants at which the condition holds) to changes of state."""

    def __init__(self, labels: list[str], name: str, hold_ms: int, resolve_ms: int, step_ms: int) -> None:
        self.labels, self.name, self.hold_ms, self.resolve_ms, self.step_ms = labels, name, hold_ms, resolve_ms, step_ms

    def init(self, handle) -> None:
        self.handle = handle
        fields = [T.StructField(n, T.LongType()) for n in ("since", "last", "firing")]
        self.state = handle.getValueState("life", T.StructType(fields))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for row in rows:
            for due in (row.at_ms, row.at_ms + self.step_ms + _CHECK, row.at_ms + self.resolve_ms + _CHECK):
                self.handle.registerTimer(due)
        return iter(())

    def _change(self, key, state: str, at_ms: int) -> Row:
        at = dt.datetime.fromtimestamp(at_ms / 1000, dt.timezone.utc)
        return Row(**{"alertname": self.name, **dict(zip(self.labels, key)), "state": state, "at": at})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now, out = expiredTimerInfo.getExpiryTimeInMs(), []
        since, last, firing = self.state.get() if self.state.exists() else (None, None, 0)
        if now % 1000 == _CHECK:
            if since is not None and firing and now - _CHECK == last + self.resolve_ms:
                out.append(self._change(key, "resolved", now - _CHECK))
                self.state.clear()
            elif since is not None and not firing and now - _CHECK == last + self.step_ms:
                out.append(self._change(key, "inactive", now - _CHECK))
                self.state.clear()
            return iter(out)
        if since is None:
            since = now
            out.append(self._change(key, "pending", now))
        if not firing and now - since >= self.hold_ms:
            firing = 1
            out.append(self._change(key, "firing", now))
        self.state.update((since, now, firing))
        return iter(out)

    def close(self) -> None:
        pass


def alert_life(log: DataFrame, labels=(), name: str = "HighErrorRate", delay: str = "10 minutes", hold: str = "5 minutes",
               resolve: str = "5 minutes", step: str = "1 minute", duration: str = "5 minutes", condition=None) -> DataFrame:
    """Changes of state of every label set's alert: alertname, labels, state, at (timestamp).

    ``resolve`` must be longer than ``step``, or a firing alert would resolve between two instants."""
    if _seconds(resolve) <= _seconds(step):
        raise ValueError("resolve must be longer than step")
    windows = sliding_counts(log, delay, duration, step, tuple(labels))
    at = F.col("w.end")
    held = windows.select(*labels, "requests", "errors", F.window_time("w").alias("evaluated"), F.unix_millis(at).alias("at_ms"))
    held = held.filter(too_many_errors() if condition is None else condition).select(*labels, "evaluated", "at_ms")
    schema = T.StructType([T.StructField("alertname", T.StringType()), *[held.schema[c] for c in labels],
                           T.StructField("state", T.StringType()), T.StructField("at", T.TimestampType())])
    life = AlertLife(list(labels), name, 1000 * _seconds(hold), 1000 * _seconds(resolve), 1000 * _seconds(step))
    return held.groupBy(*labels).transformWithState(statefulProcessor=life, outputStructType=schema, outputMode="Append", timeMode="EventTime")


def run_alert_life(spark: SparkSession, log: DataFrame, sink: str, checkpoint: str, labels=(), timeout_s: int | None = None, **rule) -> None:
    with rocksdb_state(spark):
        q = (alert_life(log, labels, **rule).writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink))
        finish(q, timeout_s)
