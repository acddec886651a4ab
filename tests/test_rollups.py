"""Trailing windows from prefix sums and sketches merged over spans, against plain counts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import rollups as RO

START = dt.datetime(2024, 1, 1, 23, 50)
SCHEMA = "ts timestamp_ntz, pod string, ok int, duration_s double, user_id long"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    # busy, silent for longer than the window, busy again; one label set comes late
    seconds = sorted([rng.randrange(3000) for _ in range(300)] + [9000 + rng.randrange(2000) for _ in range(200)])
    return [(START + dt.timedelta(seconds=s), rng.choice("ab") if s < 9500 else rng.choice("abc"), rng.randrange(2), rng.random(), rng.randrange(60)) for s in seconds]


@pytest.mark.parametrize("duration,step,range_steps", [("10 minutes", "30 seconds", 2880), ("1 hour", "1 minute", 7), ("30 seconds", "30 seconds", 1)])
def test_trailing_sums_against_counting(spark, rows, duration, step, range_steps):
    log = spark.createDataFrame(rows, SCHEMA)
    got = RO.trailing_sums(log, {"n": F.count(F.lit(1)), "good": F.sum("ok")}, ("pod",), duration, step, range_steps=range_steps).collect()
    width, every = dt.timedelta(seconds=RO._seconds(duration)), dt.timedelta(seconds=RO._seconds(step))
    epoch = dt.datetime(1970, 1, 1)
    floor = lambda t: epoch + (t - epoch) // every * every
    at, want = floor(rows[0][0]) + every, []
    while at <= floor(rows[-1][0]) + every:
        for pod in "abc":
            seen = [ok for ts, p, ok, _, _ in rows if p == pod and at - width <= ts < at]
            if seen:
                want.append((at - width, at, pod, len(seen), sum(seen)))
        at += every
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_trailing_sums_of_nothing(spark):
    log = spark.createDataFrame([], SCHEMA)
    assert RO.trailing_sums(log, {"n": F.count(F.lit(1))}).count() == 0
    with pytest.raises(ValueError):
        RO.trailing_sums(log, {"n": F.count(F.lit(1))}, duration="1 minute", step="45 seconds")


def test_spans_of_few_values_are_exact(spark, rows):
    """Below k values a KLL sketch holds them all, and few keys are counted one by one, however the steps are merged."""
    sketches = RO.step_sketches(spark.createDataFrame(rows[:150], SCHEMA), "duration_s", "user_id", ("pod",))
    quantiles = {(r.span_start, r.pod): r for r in RO.span_quantiles(sketches, (0.5, 0.9), ("pod",)).collect()}
    keys = {(r.span_start, r.pod): r.distinct_keys for r in RO.span_distinct(sketches, ("pod",)).collect()}
    for (day, pod), r in quantiles.items():
        values = sorted(v for ts, p, _, v, _ in rows[:150] if p == pod and day <= ts < day + dt.timedelta(days=1))
        assert r.observations == len(values)
        for q, found in ((0.5, r.p50), (0.9, r.p90)):
            assert found in (values[max(0, int(q * len(values)) - 1)], values[min(len(values) - 1, int(q * len(values)))])
        assert keys[day, pod] == len({u for ts, p, _, _, u in rows[:150] if p == pod and day <= ts < day + dt.timedelta(days=1)})
    assert set(keys) == set(quantiles)
