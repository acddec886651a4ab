"""Waiting for streaming queries: one helper for every runner of this package."""

from __future__ import annotations

import contextlib
import threading
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def finish(query: StreamingQuery, timeout_s: int | None = None) -> None:
    """Wait until the query ends; raise its error, or stop it and raise TimeoutError.

    A query that is still running has written part of its input only, so a
    caller must never read on as if it were done.
    """
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        name = query.name or query.id
        query.stop()
        raise TimeoutError(f"streaming query {name} did not finish within {timeout_s} s")
    if query.exception():
        raise query.exception()


@contextlib.contextmanager
def session_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Hold a session setting for the length of a block."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


class ProgressTotals(StreamingQueryListener):
    """Batches and rows of a query over all its progress events: the rows observed as
    ``rows`` under the name ``observed`` where the query does so, else its input rows.

    ``recentProgress`` keeps the last hundred only.
    """

    def __init__(self, observed: str = "bronze_rows") -> None:
        self._observed = observed
        self._of: dict[str, list[int]] = {}
        self._ended: dict[str, threading.Event] = {}

    def _end(self, run_id) -> threading.Event:
        return self._ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        totals = self._of.setdefault(str(p.runId), [0, 0])
        totals[0] += 1
        seen = p.observedMetrics.get(self._observed)
        totals[1] += p.numInputRows if seen is None else seen["rows"]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(event.runId).set()

    def of(self, query: StreamingQuery, wait_s: float = 60) -> tuple[int, int]:
        """(batches, rows) of an ended query; events arrive in order, the end last."""
        if not self._end(query.runId).wait(wait_s):
            raise TimeoutError("the end of the streaming query was not reported")
        return tuple(self._of.get(str(query.runId), (0, 0)))


_ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
            # small states in many partitions: no file is allocated ahead of what is written
            "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
            "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


@contextlib.contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """State beyond memory, for streams that are started in the block."""
    with contextlib.ExitStack() as settings:
        for key, value in _ROCKSDB.items():
            settings.enter_context(session_setting(spark, key, value))
        yield
