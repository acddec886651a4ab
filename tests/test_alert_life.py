"""The life of an alert: a plain state machine, the batch form and the stream over several batches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import alerts as AL
from tessera.streaming.alert_life import run_alert_life

START = dt.datetime(2024, 1, 1)
MINUTE = dt.timedelta(minutes=1)
SCHEMA = "event_id long, ts timestamp_ntz, http_path string, status_code int, pod string"


def machine(held, hold=5, resolve=5):
    """Transitions (state, minute) of one label set from the minutes at which the condition holds."""
    out, since, last, firing = [], None, None, False
    for now in range(min(held, default=0), max(held, default=0) + resolve + 2):
        if now in held:
            if since is None:
                since = now
                out.append(("pending", now))
            last = now
            if not firing and now - since >= hold:
                firing = True
                out.append(("firing", now))
        elif since is not None and not firing:
            out.append(("inactive", now))
            since = None
        elif since is not None and now == last + resolve:
            out.append(("resolved", now))
            since, firing = None, False
    return out


def log_of(spark, events):
    """(pod, second, failed) to request log rows."""
    return spark.createDataFrame([(i, START + dt.timedelta(seconds=s), "/predict", 500 if bad else 200, pod)
                                  for i, (pod, s, bad) in enumerate(events)], SCHEMA)


def held_minutes(events, pod):
    """Minutes at which more than 5 % of the trailing five minutes' requests failed."""
    out = set()
    for now in range(0, max(s for _, s, _ in events) // 60 + 8):
        seen = [bad for p, s, bad in events if p == pod and now - 5 <= s // 60 < now]
        if seen and sum(seen) / len(seen) > 0.05:
            out.add(now)
    return out


@pytest.fixture(scope="module")
def events():
    rng = random.Random(7)
    out = []
    for pod, rate in (("a", 0.3), ("b", 0.05), ("c", 0.9)):
        bad = False
        for minute in range(240):
            bad = bad if rng.random() < 0.9 else not bad
            out += [(pod, minute * 60 + rng.randrange(60), bad and rng.random() < rate) for _ in range(rng.choice([0, 1, 3, 6]))]
    return out


def expected(events, hold=5, resolve=5):
    return sorted((pod, state, START + minute * MINUTE) for pod in "abc" for state, minute in machine(held_minutes(events, pod), hold, resolve))


@pytest.mark.parametrize("hold,resolve", [(5, 5), (3, 8), (0, 2)])
def test_batch_equals_the_state_machine(spark, events, hold, resolve):
    evaluated = AL.evaluations(log_of(spark, events), ("pod",))
    got = AL.alert_transitions(evaluated, AL.too_many_errors(), ("pod",), hold=f"{hold} minutes", resolve=f"{resolve} minutes").collect()
    assert sorted((r.pod, r.state, r.at) for r in got) == expected(events, hold, resolve)


def test_stream_equals_the_state_machine_over_batches(spark, events, tmp_path):
    d = str(tmp_path)
    events = sorted(events, key=lambda e: e[1])
    schema = log_of(spark, events[:1]).schema
    rng = random.Random(1)
    cuts = [0, len(events) // 3, len(events) // 2, len(events)]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        part = events[a:b]
        rng.shuffle(part)
        log_of(spark, part).write.mode("append").parquet(f"{d}/log")
        run_alert_life(spark, spark.readStream.schema(schema).parquet(f"{d}/log"), f"{d}/out", f"{d}/_ck", ("pod",), delay="3 minutes")
        until = START + dt.timedelta(seconds=max(s for _, s, _ in events[:b])) - 3 * MINUTE
        got = spark.read.parquet(f"{d}/out").select("pod", "state", F.col("at").cast("timestamp_ntz").alias("at")).collect()
        assert sorted((r.pod, r.state, r.at) for r in got) == [t for t in expected(events) if t[2] < until], k
    states = {s for _, s, _ in expected(events)}
    assert states == {"pending", "inactive", "firing", "resolved"}


def test_spans_and_notification_groups(spark, events):
    evaluated = AL.evaluations(log_of(spark, events).withColumn("namespace", F.lit("churn")), ("namespace", "pod"))
    every = expected(events)
    until = max(t for _, s, t in every if s == "firing") + MINUTE  # the last one still fires
    spans = AL.alert_spans(evaluated, AL.too_many_errors(), ("namespace", "pod"), until=F.lit(until)).collect()
    fired = sorted((p, t) for p, s, t in every if s == "firing")
    assert sorted((r.pod, r.firing_at) for r in spans) == fired and sum(r.resolved_at is None for r in spans) >= 1
    groups = AL.notification_groups(AL.alert_spans(evaluated, AL.too_many_errors(), ("namespace", "pod"), until=F.lit(until)), "pod").collect()
    assert len(groups) == 1 and groups[0].members == sorted({p for p, _ in fired}) and groups[0].fired == len(fired)
    assert groups[0].first_firing == min(t for _, t in fired) and groups[0].still_firing == sum(r.resolved_at is None for r in spans)


def test_resolve_must_exceed_the_step(spark, tmp_path):
    schema = log_of(spark, [("a", 0, True)]).schema
    log_of(spark, [("a", 0, True)]).write.parquet(f"{tmp_path}/log")
    with pytest.raises(ValueError, match="longer than step"):
        run_alert_life(spark, spark.readStream.schema(schema).parquet(f"{tmp_path}/log"), f"{tmp_path}/out", f"{tmp_path}/_ck", ("pod",), resolve="1 minute")
