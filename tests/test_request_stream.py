"""Request lines and their prediction lines joined on a stream, over several batches."""

import datetime as dt
import json

from tessera.streaming.requests import run_answered_requests

START = dt.datetime(2024, 1, 1)


def line(event, request_id, second, **fields):
    at = (START + dt.timedelta(seconds=second)).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    return json.dumps({"timestamp": at, "level": "info", "event": event, "request_id": request_id, "http_method": "POST", "http_path": "/predict", **fields})


def finished(request_id, second):
    return line("request_finished", request_id, second, status_code=200, duration_ms=1.5)


def answer(request_id, second, cls):
    return line("prediction_returned", request_id, second, predicted_class=cls, probability=0.15 + 0.7 * cls)


def test_late_answers_repeats_and_unanswered_requests(spark, tmp_path):
    d = str(tmp_path)

    def batch(k, *lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{d}/log")
        run_answered_requests(spark, spark.readStream.text(f"{d}/log"), f"{d}/out", f"{d}/_ck", "10 minutes", "5 minutes")
        out = spark.read.parquet(f"{d}/out").collect()
        return sorted(((r.request_id, r.predicted_class) for r in out), key=str)

    # both lines at once; an answer before its request; a request whose answer is late; one without; one without an id; a torn line
    first = batch(0, finished("r1", 10), answer("r1", 9, 1), answer("r2", 20, 0), finished("r3", 30), finished("r4", 40), finished(None, 45),
                  line("request_failed", "r5", 50, duration_ms=2.0), '{"timestamp": "2024')
    assert first == [("r1", 1), (None, None)]
    # the late answer comes, sent twice; the other line of r2; an answer of nobody's
    second = batch(1, answer("r3", 31, 1), answer("r3", 31, 1), answer("r3", 33, 0), finished("r2", 21), answer("r9", 100, 1), finished("r6", 200))
    assert second == [("r1", 1), ("r2", 0), ("r3", 1), (None, None)]
    # time moves on: what is unanswered is given out once, and an answer outside the bound finds no request
    third = batch(2, finished("r7", 3000), answer("r6", 2900, 1))
    assert third == [("r1", 1), ("r2", 0), ("r3", 1), ("r4", None), ("r5", None), ("r6", None), (None, None)]
    # an answer for a request that was given out already is too late
    fourth = batch(3, answer("r4", 41, 1), answer("r7", 2999, 0))
    assert fourth == sorted([*third, ("r7", 0)], key=str)
    codes = {r.request_id: r.status_code for r in spark.read.parquet(f"{d}/out").collect()}
    assert codes["r5"] == 500 and codes["r1"] == 200
