"""Operator-level tests: casts, latest-per-key strategies and skew, quantiles, AUC, contract, registry."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tessera import config as C
from tessera.functions.casts import lenient_int
from tessera.functions.scoring import interpret_score, rule_prediction
from tessera.operators import evaluate as EV
from tessera.operators import ops as OP
from tessera.operators import registry as RG
from tessera.operators.clean import latest_per_key
from tessera.operators.quality import apply_contract, split_by
from .records import frame, record


def test_lenient_int(spark):
    df = spark.createDataFrame([("12",), ("12.5",), ("1e2",), ("x",), (None,), (" 7 ",)], "v string")
    got = [r[0] for r in df.select(lenient_int("v")).collect()]
    assert got == [12, 12, None, None, None, 7]


def test_split_by_is_exact_complement(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    a, b = split_by(df, F.col("x") > 1)
    assert a.count() + b.count() == 3


@pytest.mark.parametrize("strategy", ["aggregate", "window"])
def test_latest_per_key_hot_key(spark, strategy):
    # one key holds a third of the rows; ties broken by the second recency column
    rows = [(0, i // 3, i) for i in range(3000)] + [(k, k, k) for k in range(1, 6001)]
    df = spark.createDataFrame(rows, "k int, ts int, seq int").repartition(8)
    out = {r.k: (r.ts, r.seq) for r in latest_per_key(df, "k", ["ts", "seq"], strategy).collect()}
    assert len(out) == 6001
    assert out[0] == (999, 2999)
    assert out[17] == (17, 17)


def _prom_quantile(q, bounds, cums):
    total = cums[-1] if cums else 0
    if total == 0:
        return math.nan
    rank = q * total
    for i, c in enumerate(cums[:-1]):
        if c >= rank:
            start = 0.0 if i == 0 else bounds[i - 1]
            prev = 0 if i == 0 else cums[i - 1]
            return start + (bounds[i] - start) * (rank - prev) / (c - prev)
    return bounds[-1]


def test_histogram_quantile_against_reference(spark):
    random.seed(3)
    bounds = C.LATENCY_BUCKETS
    rows = []
    for g in range(40):
        n = random.choice([1, 2, 5, 50])
        for _ in range(n):
            rows.append((g, random.choice([0.001, 0.02, 0.3, 1.7, 3.0, 9.0, random.random()])))
    df = spark.createDataFrame(rows, "g int, v double").withColumn("ts", F.current_timestamp())
    got = OP.latency_quantiles(df, "v", (0.5, 0.95, 0.99), bounds, by=("g",), duration=None).collect()
    by_g = {}
    for g, v in rows:
        by_g.setdefault(g, []).append(v)
    for r in got:
        vs = by_g[r.g]
        cums = [sum(1 for v in vs if v <= b) for b in bounds] + [len(vs)]
        for q, col in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99")):
            assert r[col] == pytest.approx(_prom_quantile(q, list(bounds), cums), rel=1e-12)


def test_auc_matches_brute_force_and_mllib(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    random.seed(7)
    rows = [(random.randint(0, 1), round(random.random(), 2)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "label int, score double")
    got = EV.roc_auc(df, "label", "score", buckets=16).first().auc
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert got == pytest.approx(won / (len(pos) * len(neg)), abs=1e-12)
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert got == pytest.approx(ev.evaluate(df.withColumn("label", F.col("label").cast("double"))), abs=1e-9)


def test_contract_and_rule(spark):
    months = {f: int(f.endswith("month_to_month")) for f in C.CONTRACT_DEFAULTED_FLAGS if f.startswith("contract_type_")}
    out = apply_contract(frame(spark, [record(tenure_months=40, **months), record(tenure_months=4, **months), record(tenure_months=4)]))
    got = [(r.p.prediction, r.p.probability) for r in out.withColumn("p", rule_prediction()).collect()]
    assert got == [(0, 0.15), (1, 0.85), (0, 0.15)]


def test_interpret_score(spark):
    df = spark.createDataFrame([(0.3,), (0.7,), (0.0,), (1.0,), (0.5,)], "v double")
    got = [(r.p.prediction, r.p.probability) for r in df.select(interpret_score(F.col("v")).alias("p")).collect()]
    assert got == [(0, 0.3), (1, 0.7), (0, 0.0), (1, 1.0), (1, 0.5)]


def test_registry_flow(spark, tmp_path):
    reg = RG.Registry(spark, str(tmp_path))
    with pytest.raises(RG.NoRunsError):
        reg.best_run("exp")
    runs = spark.createDataFrame(
        [(f"r{i}", "exp", f"run{i}", "fam", {"p": str(i)}, {"val_f1": f1}, {"model_family": "fam"}, None, None,
          None) for i, f1 in enumerate([0.74, 0.79, 0.78])],
        RG.__dict__.get("RUNS_SCHEMA") or __import__("tessera.operators.train", fromlist=["x"]).RUNS_SCHEMA)
    reg.log_runs(runs)
    best = reg.best_run("exp").first()
    assert best.run_id == "r1"
    v1 = reg.register(reg.best_run("exp"), "m")
    reg.set_alias("m", "production", v1)
    v2 = reg.register(reg.runs().filter("run_id = 'r2'"), "m")
    reg.set_alias("m", "production", v2)
    info = reg.model_info("m", "production").first()
    assert (info.version, info.alias, info.flavor) == ("2", "production", "fam")
    tags = reg.versions().filter("version = 1").first().tags
    assert tags["val_f1"] == "0.7900" and tags["winning_family"] == "fam"


def test_approx_distinct_and_raw_quantiles(spark):
    from tessera.operators.quality import quality_report

    df = spark.range(0, 20000).select((F.col("id") % 5000).alias("k"), (F.col("id") / 20000.0).alias("v"))
    exact = quality_report(df, "k").first()
    approx = quality_report(df, "k", approx_rsd=0.02).first()
    assert exact.distinct_keys == 5000 and abs(approx.distinct_keys - 5000) < 5000 * 0.08
    q = OP.raw_latency_quantiles(df.withColumn("ts", F.current_timestamp()), "v", (0.5, 0.99), duration=None).first()
    assert q.observations == 20000 and abs(q.p50 - 0.5) < 0.01 and abs(q.p99 - 0.99) < 0.01


def test_label_match_is_anchored(spark):
    df = spark.createDataFrame([("500",), ("5000",), ("1500",), ("503",), ("backend-7f",), ("xbackend-1",)], "v string")
    got = [r.v for r in df.filter(OP.label_match("v", "5..")).collect()]
    assert got == ["500", "503"]
    assert [r.v for r in df.filter(OP.label_match("v", "backend-.*")).collect()] == ["backend-7f"]


def test_request_id_forms(spark):
    from tessera.functions.scoring import request_id

    df = spark.range(3).select(request_id(F.col("id")).alias("a"), request_id().alias("b"))
    rows = df.collect()
    assert all(r.a.startswith("req_") and len(r.a) == 16 and len(r.b) == 16 for r in rows)
    assert len({r.b for r in rows}) == 3
    assert [r.a for r in rows] == [r.a for r in df.select("a").collect()]        # replayable


def test_failed_requests_count_but_have_no_latency(spark):
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1, 0, 0, 30)
    log = spark.createDataFrame(
        [(t0, "POST", "/predict", 200, 0.02), (t0, "POST", "/predict", 500, None), (t0, "POST", "/predict", 200, 0.3)],
        "ts timestamp_ntz, http_method string, http_path string, status_code int, duration_s double")
    assert OP.request_counters(log).agg(F.sum("requests")).first()[0] == 3
    h = {r.le: r.cumulative_count for r in OP.latency_histogram(log).collect()}
    assert h["+Inf"] == 2 and h["0.025"] == 1 and h["0.5"] == 2
    er = OP.error_ratio(log).filter(F.col("window_end") == F.lit("2024-01-01 00:01:00").cast("timestamp_ntz")).first()
    assert (er.requests, er.errors) == (3, 1) and er.band == "red"


def test_quantile_without_observations_is_nan(spark):
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1, 0, 0, 30)
    log = spark.createDataFrame([(t0, None), (t0, None)], "ts timestamp_ntz, duration_s double")
    r = OP.latency_quantiles(log, duration=None).first()
    assert r.observations == 0 and math.isnan(r.p50) and math.isnan(r.p99)
    one = spark.createDataFrame([(t0, 9.0)], "ts timestamp_ntz, duration_s double")
    assert OP.latency_quantiles(one, duration=None).first().p99 == 2.5          # +Inf bucket -> top bound


@pytest.mark.parametrize("strict", [False, True])
def test_binary_metrics_brute_force(spark, strict):
    random.seed(11)
    rows = [(random.choice(["a", "b"]), random.randint(0, 1), random.choice([0.2, 0.5, 0.5, 0.7, round(random.random(), 1)]))
            for _ in range(2000)]
    df = spark.createDataFrame(rows, "g string, label int, score double")
    got = {r.g: r for r in EV.binary_metrics(df, "label", "score", 0.5, ["g"], strict=strict, buckets=4).collect()}
    for g in ("a", "b"):
        sub = [(y, s) for gg, y, s in rows if gg == g]
        hit = (lambda s: s > 0.5) if strict else (lambda s: s >= 0.5)
        tp = sum(1 for y, s in sub if y == 1 and hit(s))
        fp = sum(1 for y, s in sub if y == 0 and hit(s))
        fn = sum(1 for y, s in sub if y == 1 and not hit(s))
        tn = sum(1 for y, s in sub if y == 0 and not hit(s))
        r = got[g]
        assert (r.tp, r.fp, r.fn, r.tn) == (tp, fp, fn, tn)
        assert r.f1 == pytest.approx(2 * tp / (2 * tp + fp + fn))
        pos = [s for y, s in sub if y == 1]
        neg = [s for y, s in sub if y == 0]
        won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        assert r.auc == pytest.approx(won / (len(pos) * len(neg)), abs=1e-12)
    whole = EV.binary_metrics(df, "label", "score", 0.5, strict=strict).first()
    assert whole.tp == got["a"].tp + got["b"].tp


def test_auc_products_do_not_overflow(spark):
    """8e9 positives above 8e9 negatives: 6.4e19 pairs are beyond a long."""
    n = 8_000_000_000
    rows = spark.createDataFrame([("g", 0, 0, n, 0.0, n, n), ("g", 1, n, 0, 0.0, n, n)], "g string, _b int, _P long, _N long, _W double, n_pos long, n_neg long")
    won = EV._won_pairs(rows, ["g"])
    assert won.select(EV._auc(won).alias("auc")).first().auc == 1.0


def test_binary_metrics_of_counted_rows(spark):
    random.seed(5)
    rows = [(random.randint(0, 1), random.choice([0.1, 0.4, 0.6, 0.9])) for _ in range(500)]
    df = spark.createDataFrame(rows, "label int, score double")
    counted = df.groupBy("label", "score").agg(F.count(F.lit(1)).alias("n"))
    assert (EV.binary_metrics(counted, "label", "score", 0.5, weight="n").collect()
            == EV.binary_metrics(df, "label", "score", 0.5).collect())


def test_prediction_lines_join_their_request(spark):
    lines = [
        '{"timestamp":"2024-01-01T00:00:01Z","event":"prediction_returned","request_id":"r1","predicted_class":0,"probability":0.2}',
        '{"timestamp":"2024-01-01T00:00:02Z","event":"request_finished","request_id":"r1","status_code":200}',
        # a client repeats its id: two requests, the latest answer, no further rows
        '{"timestamp":"2024-01-01T00:00:03Z","event":"prediction_returned","request_id":"r1","predicted_class":1,"probability":0.9}',
        '{"timestamp":"2024-01-01T00:00:04Z","event":"request_finished","request_id":"r1","status_code":200}',
        '{"timestamp":"2024-01-01T00:00:05Z","event":"request_failed","request_id":"r2","duration_ms":3.5}',
        '{"timestamp":"2024-01-01T00:00:06Z","event":"request_finished","status_code":200}',
        '{"timestamp":"2024-01-01T00:00:07Z","event":"prediction_returned","predicted_class":1,"probability":0.7}',
        '{"timestamp":"2024-01-01T00:00:08Z","event":"prediction_returned","request_id":"r9","predicted_class":1}',
        '{"timestamp":"2024-01-01T00:00:09Z","event":"request_fin',
    ]
    parsed = OP.parse_log(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert parsed.filter("_bad_line IS NOT NULL").count() == 1
    got = sorted((str(r.request_id), r.ts.second, r.status_code, r.predicted_class, r.probability)
                 for r in OP.request_predictions(parsed).collect())
    assert got == [("None", 6, 200, None, None), ("r1", 2, 200, 1, 0.9), ("r1", 4, 200, 1, 0.9),
                   ("r2", 5, 500, None, None)]
