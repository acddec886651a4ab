"""Queries of the model side: sweeps and runs, leaderboard, best run, registry,
alias resolution, scoring, contract (M1-M16, J1, K2-K4, C1-C5, V5-V11, U1)."""

from __future__ import annotations

import json
import uuid
from functools import reduce

import numpy as np
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scoring import rule_prediction
from ..operators import evaluate as EV
from ..operators import network as NN
from ..operators import quality as QA
from ..operators import registry as RG
from ..operators import score as SC
from ..operators import train as TR
from ..session import work_path
from ..streaming.scoring import run_registered_scoring
from . import standins as S
from .queries import round6, GOLD_SQL, LABELLED_SQL, ROUND, gold_churn, r, register, rounded

# ---------------------------------------------------------------------------
# A sweep whose runs Spark derives from the data: threshold rules on lineitem
# ---------------------------------------------------------------------------

RULE_GRID = (("l_discount", 0.02), ("l_discount", 0.04), ("l_discount", 0.06), ("l_discount", 0.08),
             ("l_tax", 0.02), ("l_tax", 0.04), ("l_tax", 0.06))
RULE_EXPERIMENT = "rule_sweep"
RULE_FAMILY = "threshold_rule"
STARTED = "2024-01-01 00:00:00"
METRICS = ("val_accuracy", "val_precision", "val_recall", "val_f1", "val_auc")


def _run_name(feature, t):
    return f"rule_{feature}_{t}"


def rule_sweep_metrics(spark, d):
    """Every grid point evaluated on the validation split in one pass: rows are counted
    per (label, values) first, only the counts fan out over the grid."""
    li = S.labelled_rows(spark, d).filter(F.col("_split") == "val").groupBy("label", "l_discount", "l_tax").agg(F.count(F.lit(1)).alias("n"))
    grid = F.explode(F.array(*[F.struct(F.lit(_run_name(f, t)).alias("run_name"), F.lit(f).alias("feature"),
                                        F.lit(float(t)).alias("threshold")) for f, t in RULE_GRID]))
    x = li.select("label", "n", "l_discount", "l_tax", grid.alias("g")).select(
        "label", "n", "g.*", F.when(F.col("g.feature") == "l_discount", F.col("l_discount"))
                         .otherwise(F.col("l_tax")).alias("score"))
    # confusion counts at the run's threshold and the AUC of its score, one pass
    return EV.binary_metrics(x, "label", "score", "threshold", ["run_name", "feature"], weight="n")


def rule_runs(spark, d):
    m = rule_sweep_metrics(spark, d)
    return m.select(
        F.col("run_name").alias("run_id"), F.lit(RULE_EXPERIMENT).alias("experiment"), "run_name",
        F.lit(RULE_FAMILY).alias("family"),
        F.create_map(F.lit("feature"), F.col("feature"), F.lit("threshold"), F.col("threshold").cast("string"))
         .alias("params"),
        F.create_map(*[x for k, c in zip(METRICS, ("accuracy", "precision", "recall", "f1", "auc"))
                       for x in (F.lit(k), F.col(c))]).alias("metrics"),
        F.create_map(F.lit("model_family"), F.lit(RULE_FAMILY)).alias("tags"),
        F.lit(None).cast("string").alias("model_path"), F.lit(None).cast("string").alias("signature"),
        F.lit(STARTED).cast("timestamp").alias("started_at"))


def _ratio_sql(num, den):
    return f"CASE WHEN ({den}) > 0 THEN CAST({num} AS DOUBLE) / ({den}) ELSE 0.0 END"


_GRID_VALUES = ", ".join(f"('{_run_name(f, t)}', '{f}', {float(t)!r}::DOUBLE)" for f, t in RULE_GRID)
RULE_RUNS_SQL = f"""
WITH v AS (SELECT label, l_discount, l_tax FROM ({LABELLED_SQL}) a WHERE _split = 'val'),
g AS (SELECT * FROM (VALUES {_GRID_VALUES}) g(run_name, feature, threshold)),
x AS (SELECT g.run_name, g.feature, g.threshold, v.label,
             CASE WHEN g.feature = 'l_discount' THEN v.l_discount ELSE v.l_tax END AS score
      FROM v CROSS JOIN g),
cm AS (SELECT run_name, feature, threshold,
         count(*) FILTER (WHERE label = 1 AND score >= threshold) AS tp,
         count(*) FILTER (WHERE label = 0 AND score >= threshold) AS fp,
         count(*) FILTER (WHERE label = 0 AND score < threshold) AS tn,
         count(*) FILTER (WHERE label = 1 AND score < threshold) AS fn
       FROM x GROUP BY ALL),
rk AS (SELECT run_name, label, rank() OVER (PARTITION BY run_name ORDER BY score) AS lo,
              count(*) OVER (PARTITION BY run_name ORDER BY score RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi
       FROM x),
au AS (SELECT run_name, sum(label) AS n_pos, sum(1 - label) AS n_neg,
              sum(CASE WHEN label = 1 THEN (lo + hi) / 2.0 ELSE 0 END) AS prs FROM rk GROUP BY run_name)
SELECT cm.run_name, feature, threshold,
  {_ratio_sql('tp + tn', 'tp + fp + tn + fn')} AS val_accuracy,
  {_ratio_sql('tp', 'tp + fp')} AS val_precision,
  {_ratio_sql('tp', 'tp + fn')} AS val_recall,
  {_ratio_sql('2 * tp', '2 * tp + fp + fn')} AS val_f1,
  CASE WHEN n_pos > 0 AND n_neg > 0 THEN (prs - n_pos * (n_pos + 1) / 2.0) / (n_pos * n_neg) ELSE 0.0 END AS val_auc
FROM cm JOIN au ON cm.run_name = au.run_name"""


def _flat(runs):
    return runs.select("run_name", *[round6(F.col("metrics")[m]).alias(m) for m in METRICS])


@register("rule_grid_runs", f"""
SELECT run_name, {", ".join(r(m, m) for m in METRICS)} FROM ({RULE_RUNS_SQL}) q""")
def q_rule_grid_runs(spark, d):
    return _flat(rule_runs(spark, d))


@register("leaderboard", f"""
SELECT run_name, {r('val_f1', 'val_f1')}, {r('val_auc', 'val_auc')},
  CAST(row_number() OVER (ORDER BY val_f1 DESC, run_name) AS INTEGER) AS rank
FROM ({RULE_RUNS_SQL}) q ORDER BY val_f1 DESC, run_name LIMIT 10""")
def q_leaderboard(spark, d):
    reg = RG.Registry(spark, work_path(spark, "registry"))
    reg.log_runs(rule_runs(spark, d))
    lb = RG.leaderboard(reg.runs().filter(F.col("tags")["model_family"] == RULE_FAMILY), "val_f1", 10)
    return lb.select("run_name", round6(F.col("metrics")["val_f1"]).alias("val_f1"),
                     round6(F.col("metrics")["val_auc"]).alias("val_auc"), F.col("rank"))


@register("best_run", f"""
SELECT run_name, '{RULE_FAMILY}' AS family, {r('val_f1', 'val_f1')}, {r('val_accuracy', 'val_accuracy')},
  {r('val_auc', 'val_auc')}
FROM ({RULE_RUNS_SQL}) q ORDER BY val_f1 DESC, run_name LIMIT 1""")
def q_best_run(spark, d):
    reg = RG.Registry(spark, work_path(spark, "registry"))
    reg.log_runs(rule_runs(spark, d))
    b = reg.best_run(RULE_EXPERIMENT)
    return b.select("run_name", "family", *[round6(F.col("metrics")[m]).alias(m)
                                            for m in ("val_f1", "val_accuracy", "val_auc")])


MODEL_NAME = "churn_classifier"


def _registered(spark, d):
    """Register the best and the second-best run; ``production`` moves v1 -> v2,
    ``staging`` stays on v1."""
    reg = RG.Registry(spark, work_path(spark, "registry"))
    reg.log_runs(rule_runs(spark, d))
    ranked = reg.search(RULE_EXPERIMENT).limit(2).collect()       # two run rows
    v1 = reg.register(reg.runs().filter(F.col("run_id") == ranked[0].run_id), MODEL_NAME)
    reg.set_alias(MODEL_NAME, "production", v1)
    v2 = reg.register(reg.runs().filter(F.col("run_id") == ranked[1].run_id), MODEL_NAME)
    reg.set_alias(MODEL_NAME, "staging", v1)
    reg.set_alias(MODEL_NAME, "production", v2)
    return reg


_RANKED_SQL = f"SELECT *, row_number() OVER (ORDER BY val_f1 DESC, run_name) AS pos FROM ({RULE_RUNS_SQL}) q"


@register("register_and_alias", f"""
SELECT '{MODEL_NAME}' AS name, CASE WHEN pos = 1 THEN 'staging' ELSE 'production' END AS alias,
  CAST(pos AS INTEGER) AS version, run_name AS run_id, printf('%.4f', val_f1) AS tag_val_f1,
  '{RULE_FAMILY}' AS tag_family
FROM ({_RANKED_SQL}) q WHERE pos <= 2""")
def q_register_and_alias(spark, d):
    reg = _registered(spark, d)
    a = reg.aliases().join(reg.versions(), ["name", "version"])
    return a.select("name", "alias", "version", "run_id", F.col("tags")["val_f1"].alias("tag_val_f1"),
                    F.col("tags")["winning_family"].alias("tag_family"))


@register("resolve_alias", f"""
SELECT '{MODEL_NAME}' AS name, 'production' AS alias, 2 AS version, run_name AS run_id, feature,
  CAST(threshold AS VARCHAR) AS threshold
FROM ({_RANKED_SQL}) q WHERE pos = 2""")
def q_resolve_alias(spark, d):
    res = _registered(spark, d).resolve(MODEL_NAME, "production")
    return res.select("name", "alias", "version", "run_id", F.col("params")["feature"].alias("feature"),
                      F.col("params")["threshold"].alias("threshold"))


@register("model_info", f"""
SELECT '{MODEL_NAME}' AS name, '2' AS version, 'production' AS alias, '{RULE_FAMILY}' AS flavor
FROM ({_RANKED_SQL}) q WHERE pos = 2""")
def q_model_info(spark, d):
    return _registered(spark, d).model_info(MODEL_NAME, "production")


# ---------------------------------------------------------------------------
# MLlib sweeps on the Gold churn table.  MLlib is not SQL: what SQL can say is
# checked -- runs of the grid, rows and positives each model scored per split,
# and that the metrics of the stored artifact are the logged ones.
# ---------------------------------------------------------------------------

def _verified_runs(spark, d, family, grid):
    gold = gold_churn(spark, d).checkpoint(eager=True)   # cut lineage: every grid point re-reads it
    runs = TR.fit_grid(spark, gold, family, grid, "churn_experiments",
                       model_root=f"{work_path(spark, 'sweep')}/models", sample_rows=None)
    held_out = gold.filter(F.col("_split").isin("val", "test"))
    checks = []
    for run in runs.collect():                            # one row per grid point
        scored = TR.positive_probability(TR.load_model(run.model_path).transform(held_out))
        again = EV.binary_metrics(scored, C.LABEL_COLUMN, "prob_1", 0.5, ["_split"], strict=True)
        logged = {f"{sp}_{k}": F.lit(run.metrics[f"{sp}_{k}"]) for sp in ("val", "test") for k in TR.METRIC_KEYS}
        of_split = {k: F.when(F.col("_split") == "val", logged[f"val_{k}"]).otherwise(logged[f"test_{k}"])
                    for k in TR.METRIC_KEYS}
        agree, valid = F.lit(True), F.lit(True)
        for k in TR.METRIC_KEYS:
            agree = agree & (F.abs(F.col(k) - of_split[k]) < 1e-9)
            valid = valid & of_split[k].between(0.0, 1.0)
        checks.append(again.select(
            F.lit(run.run_name).alias("run_name"), F.lit(run.family).alias("family"),
            F.lit(len(run.params)).alias("n_params"), "_split",
            (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("scored_rows"),
            (F.col("tp") + F.col("fn")).alias("positives"),
            agree.cast("int").alias("metrics_agree"), valid.cast("int").alias("metrics_valid")))
    return reduce(lambda x, y: x.unionByName(y), checks)


def _verified_runs_sql(family, runs):
    values = ", ".join(f"('{name}', {n_params})" for name, n_params in runs)
    return f"""
SELECT run_name, '{family}' AS family, CAST(n_params AS INTEGER) AS n_params, _split, scored_rows, positives,
  1 AS metrics_agree, 1 AS metrics_valid
FROM (VALUES {values}) g(run_name, n_params) CROSS JOIN (
  SELECT _split, count(*) AS scored_rows, count(*) FILTER (WHERE churn = 1) AS positives
  FROM ({GOLD_SQL}) g WHERE _split IN ('val', 'test') GROUP BY _split) s"""


@register("rf_grid_runs", _verified_runs_sql(
    "random_forest", [(f"rf_n{p['n_estimators']}_d{p['max_depth']}", len(p)) for p in C.RF_GRID]))
def q_rf_grid_runs(spark, d):
    return _verified_runs(spark, d, "random_forest", C.RF_GRID)


@register("nn_grid_runs", _verified_runs_sql(
    "neural_network", [(f"nn_h{p['hidden_units']}_d{p['dropout']}", len(p)) for p in C.NN_GRID]))
def q_nn_grid_runs(spark, d):
    return _verified_runs(spark, d, "neural_network", C.NN_GRID)


def _checked_envelope(env):
    """Envelope rows with the model's numbers as checks: valid output, class on its side of the threshold."""
    side = F.when(F.col("prediction") == 1, F.col("probability") >= 0.5).otherwise(F.col("probability") <= 0.5)
    return env.select(C.ID_COLUMN, "model_version", "model_name", "request_id", "output_ok",
                      side.cast("int").alias("class_agrees"))


MODEL_ENVELOPE_SQL = f"""
SELECT customer_id, '1' AS model_version, '{MODEL_NAME}' AS model_name,
  'req_' || substr(sha256(customer_id), 1, 12) AS request_id, 1 AS output_ok, 1 AS class_agrees
FROM ({GOLD_SQL}) g"""


@register("score_model_batch", MODEL_ENVELOPE_SQL)
def q_score_model_batch(spark, d):
    gold = gold_churn(spark, d).checkpoint(eager=True)
    feats = [c for c in C.GOLD_FEATURES]
    p = C.RF_GRID[0]
    model = TR.rf_pipeline(feats, C.LABEL_COLUMN, p["n_estimators"], p["max_depth"]).fit(
        gold.filter(F.col("_split") == "train").withColumn(C.LABEL_COLUMN, F.col(C.LABEL_COLUMN).cast("double"))
    ).copy()                                  # drop the training summary before scoring
    scored = SC.score_model(gold, model)
    return _checked_envelope(SC.envelope_of(scored, C.ID_COLUMN, "1", MODEL_NAME, keep=(C.ID_COLUMN,)))


# ---------------------------------------------------------------------------
# Rule scoring, envelope and the record contract
# ---------------------------------------------------------------------------

RULE_SQL = (f"CASE WHEN coalesce(contract_type_month_to_month, 0) <> 0 AND "
            f"coalesce(tenure_months, {C.RULE_MISSING_TENURE}) < {C.RULE_SHORT_TENURE}")


@register("score_rule", f"""
SELECT customer_id, {RULE_SQL} THEN {C.RULE_POSITIVE[0]} ELSE {C.RULE_NEGATIVE[0]} END AS prediction,
  {RULE_SQL} THEN {C.RULE_POSITIVE[1]}::DOUBLE ELSE {C.RULE_NEGATIVE[1]}::DOUBLE END AS probability
FROM ({GOLD_SQL}) g""")
def q_score_rule(spark, d):
    g = gold_churn(spark, d)
    return g.select(C.ID_COLUMN, rule_prediction().alias("p")).select(C.ID_COLUMN, "p.*")


def _envelope_sql(src):
    return f"""
SELECT customer_id, {RULE_SQL} THEN {C.RULE_POSITIVE[0]} ELSE {C.RULE_NEGATIVE[0]} END AS prediction,
  round({RULE_SQL} THEN {C.RULE_POSITIVE[1]}::DOUBLE ELSE {C.RULE_NEGATIVE[1]}::DOUBLE END, 4) AS probability,
  '0' AS model_version, 'mock' AS model_name, 'req_' || substr(sha256(customer_id), 1, 12) AS request_id,
  1 AS output_ok
FROM ({src}) g"""


@register("prediction_envelope", _envelope_sql(GOLD_SQL))
def q_prediction_envelope(spark, d):
    scored = SC.score_rule(gold_churn(spark, d))
    return SC.envelope_of(scored, C.ID_COLUMN, "0", "mock", keep=(C.ID_COLUMN,))


def _records(spark, d):
    """Gold rows as scoring records, with injected contract violations:
    senior_citizen = 2 (key % 61 = 0), is_long_tenure missing (key % 67 = 0);
    negative charges occur naturally (negative account balances)."""
    g = gold_churn(spark, d)
    k = F.col(C.ID_COLUMN).try_cast("bigint")
    return g.withColumns({
        "senior_citizen": F.when(k % 61 == 0, F.lit(2)).otherwise(F.col("senior_citizen")),
        "is_long_tenure": F.when(k % 67 == 0, F.lit(None).cast("int")).otherwise(F.col("is_long_tenure")),
    })


_RECORDS_SQL = f"""
SELECT * REPLACE (CASE WHEN CAST(customer_id AS BIGINT) % 61 = 0 THEN 2 ELSE senior_citizen END AS senior_citizen,
                  CASE WHEN CAST(customer_id AS BIGINT) % 67 = 0 THEN NULL ELSE is_long_tenure END AS is_long_tenure)
FROM ({GOLD_SQL}) g"""


def _contract_msgs_sql() -> str:
    msgs = []
    for name, (lo, hi) in C.CONTRACT_RANGES.items():
        msgs.append(f"CASE WHEN {name} IS NULL THEN '{name}: missing' END")
        bad = " OR ".join(x for x in (f"{name} < {lo!r}" if lo is not None else None,
                                      f"{name} > {hi!r}" if hi is not None else None) if x)
        rng = f"[{lo}, {'inf' if hi is None else hi}]"
        msgs.append(f"CASE WHEN {name} IS NOT NULL AND ({bad}) THEN '{name}: out of range {rng}' END")
    for name in C.CONTRACT_REQUIRED_FLAGS:
        msgs.append(f"CASE WHEN {name} IS NULL THEN '{name}: missing' END")
        msgs.append(f"CASE WHEN {name} IS NOT NULL AND {name} NOT IN (0, 1) THEN '{name}: not in (0, 1)' END")
    for name in C.CONTRACT_DEFAULTED_FLAGS:
        msgs.append(f"CASE WHEN {name} IS NOT NULL AND {name} NOT IN (0, 1) THEN '{name}: not in (0, 1)' END")
    return "list_filter([" + ", ".join(msgs) + "], lambda m: m IS NOT NULL)"


_CHECKED_SQL = f"SELECT *, {_contract_msgs_sql()} AS _errors FROM ({_RECORDS_SQL}) x"


@register("contract_errors", f"""
SELECT customer_id, CAST(len(_errors) AS INTEGER) AS n_errors, array_to_string(_errors, '; ') AS errors
FROM ({_CHECKED_SQL}) c WHERE len(_errors) > 0""")
def q_contract_errors(spark, d):
    checked = QA.apply_contract(_records(spark, d), keep=(C.ID_COLUMN,))
    bad, _ = QA.split_by(checked, F.size("_errors") > 0)
    return bad.select(C.ID_COLUMN, F.size("_errors").alias("n_errors"),
                      F.array_join("_errors", "; ").alias("errors"))


@register("contract_valid", _envelope_sql(f"SELECT * FROM ({_CHECKED_SQL}) c WHERE len(_errors) = 0"))
def q_contract_valid(spark, d):
    scored, _ = SC.contract_then_score(_records(spark, d), keep=(C.ID_COLUMN,))
    return SC.envelope_of(scored, C.ID_COLUMN, "0", "mock", keep=(C.ID_COLUMN,))


# ---------------------------------------------------------------------------
# Train -> register -> alias -> load by alias -> score
# ---------------------------------------------------------------------------

@register("registered_model_scoring", MODEL_ENVELOPE_SQL)
def q_registered_model_scoring(spark, d):
    """The whole model side on Gold: NN sweep with stored artifacts, best run by
    val_f1 registered and aliased, loaded back by alias, every Gold row scored."""
    root = work_path(spark, "model_flow")
    gold = gold_churn(spark, d).checkpoint(eager=True)
    reg = RG.Registry(spark, f"{root}/registry")
    reg.log_runs(TR.fit_grid(spark, gold, "neural_network", C.NN_GRID, "churn_experiments",
                             model_root=f"{root}/models", sample_rows=None))
    version = reg.register(reg.best_run("churn_experiments"), MODEL_NAME)
    reg.set_alias(MODEL_NAME, "production", version)
    model, v = RG.load_by_alias(reg, MODEL_NAME, "production", expected_schema=gold)
    scored = SC.score_model(gold, model)
    return _checked_envelope(SC.envelope_of(scored, C.ID_COLUMN, v, MODEL_NAME, keep=(C.ID_COLUMN,)))


# ---------------------------------------------------------------------------
# Foreign model (U1) and a stream scored by the alias (C5, J1): models of known weights, so SQL gives the same numbers
# ---------------------------------------------------------------------------

LINEAR = {"weights": {"tenure_months": -0.05, "monthly_charges": 0.02, "contract_type_month_to_month": 1.5}, "bias": -1.0}


def _of_score_sql(score: str, src: str, version: str, name: str) -> str:
    p = f"1 / (1 + exp(-({score})))"
    return f"""
SELECT customer_id, CAST({p} > 0.5 AS INTEGER) AS prediction, round({p}, 4) AS probability, {version} AS model_version,
  '{name}' AS model_name, 'req_' || substr(sha256(customer_id), 1, 12) AS request_id, 1 AS output_ok
FROM ({src}) g"""


@register("foreign_model_scoring", _of_score_sql(
    " + ".join([*(f"{w!r}::DOUBLE * {c}" for c, w in LINEAR["weights"].items()), f"{LINEAR['bias']!r}::DOUBLE"]), GOLD_SQL, "'7'", "linear"))
def q_foreign_model_scoring(spark, d):
    name = SC.ship_artifact(spark, f"linear-{uuid.uuid4().hex[:12]}.json", json.dumps(LINEAR))
    gold = gold_churn(spark, d).select(C.ID_COLUMN, *LINEAR["weights"])
    scored = SC.pandas_predictor(gold, SC.shipped_linear_model(name), list(LINEAR["weights"]), model_key=name)
    return SC.envelope_of(scored, C.ID_COLUMN, "7", "linear", keep=(C.ID_COLUMN,))


#: Two networks of two hidden units over two features, with the scaling that goes with them.
_NETWORK = {"features": ["tenure_months", "monthly_charges"], "mean": [24.0, 60.0], "scale": [12.0, 25.0]}
_WEIGHTS = {"1": [0.5, -1.0, 1.0, 0.25, 0.1, -0.2, 0.75, -0.5, 0.05], "2": [-0.3, 0.8, 0.6, -0.9, 0.0, 0.3, -1.1, 0.4, -0.15]}


def _network_sql(weights) -> str:
    x = [f"((coalesce({f}, {m!r}) - {m!r}::DOUBLE) / {s!r}::DOUBLE)" for f, m, s in zip(*_NETWORK.values())]
    hidden = [f"greatest({x[0]} * {weights[j]!r}::DOUBLE + {x[1]} * {weights[2 + j]!r}::DOUBLE + {weights[4 + j]!r}::DOUBLE, 0)" for j in range(2)]
    return f"{hidden[0]} * {weights[6]!r}::DOUBLE + {hidden[1]} * {weights[7]!r}::DOUBLE + {weights[8]!r}::DOUBLE"


_EVEN = "TRY_CAST(customer_id AS BIGINT) % 2 = 0"


@register("score_stream_by_alias", _of_score_sql(
    f"CASE WHEN {_EVEN} THEN {_network_sql(_WEIGHTS['1'])} ELSE {_network_sql(_WEIGHTS['2'])} END",
    f"SELECT * FROM ({_CHECKED_SQL}) c WHERE len(_errors) = 0", f"CASE WHEN {_EVEN} THEN '1' ELSE '2' END", MODEL_NAME))
def q_score_stream_by_alias(spark, d):
    """Records of even keys arrive while the alias points to version 1, the others after it has moved to version 2."""
    root = work_path(spark, "score_by_alias")
    reg = RG.Registry(spark, f"{root}/registry")
    for version, weights in _WEIGHTS.items():
        path = f"{root}/models/{version}"
        NN.NetworkModel(NN.Scaling(**_NETWORK), 2, np.array(weights)).save(spark, path)
        run = spark.createDataFrame([(version, "exp", f"run{version}", "neural_network", {}, {"val_f1": 0.0}, {"model_family": "neural_network"}, path,
                                      None, None)], TR.RUNS_SCHEMA)
        reg.log_runs(run)
        reg.register(run, MODEL_NAME)
    records = _records(spark, d)
    even = F.col(C.ID_COLUMN).try_cast("bigint") % 2 == 0
    for version, part in (("1", records.filter(even)), ("2", records.filter(~even))):
        reg.set_alias(MODEL_NAME, "production", int(version))
        part.write.mode("append").parquet(f"{root}/records")
        run_registered_scoring(spark, reg, MODEL_NAME, f"{root}/records", records.schema, f"{root}/out", f"{root}/_checkpoint", C.ID_COLUMN)
    return spark.read.parquet(f"{root}/out/scored").drop("batch")


def _registered_network(spark, root, version="1"):
    """A registry with one stored network of known weights."""
    reg = RG.Registry(spark, f"{root}/registry")
    path = f"{root}/models/{version}"
    NN.NetworkModel(NN.Scaling(**_NETWORK), 2, np.array(_WEIGHTS[version])).save(spark, path)
    run = spark.createDataFrame([(version, "exp", f"run{version}", "neural_network", {}, {"val_f1": 0.0}, {}, path, None, None)], TR.RUNS_SCHEMA)
    reg.log_runs(run)
    reg.set_alias(MODEL_NAME, "production", reg.register(run, MODEL_NAME))
    return reg


@register("configured_predictor", _envelope_sql(GOLD_SQL) + " UNION ALL " + _of_score_sql(_network_sql(_WEIGHTS["1"]), GOLD_SQL, "'1'", MODEL_NAME))
def q_configured_predictor(spark, d):
    """The predictor that the configuration names (C4): the rule where the service is mocked, else the registered model."""
    gold = gold_churn(spark, d)
    reg = _registered_network(spark, work_path(spark, "configured"))
    out = []
    for mock in (True, False):
        predict, about = SC.choose_predictor(mock, reg, MODEL_NAME)
        out.append(SC.envelope_of(predict(gold), C.ID_COLUMN, about["model_version"], about["model_name"], keep=(C.ID_COLUMN,)))
    return out[0].unionByName(out[1])


@register("model_input_example", f"""
SELECT {", ".join(C.GOLD_FEATURES[:6])}, {", ".join(r(c, c) for c in ("monthly_charges", "total_charges"))}
FROM ({GOLD_SQL}) g WHERE _split = 'train' ORDER BY customer_id LIMIT 3""")
def q_model_input_example(spark, d):
    """The input example stored with a fitted network, read back from its artifact (K4, M9)."""
    gold = gold_churn(spark, d).checkpoint(eager=True)
    grid = [{"hidden_units": 4, "dropout": 0.0, "epochs": 1, "batch_size": 16}]
    run = TR.fit_grid(spark, gold, "neural_network", grid, "examples", model_root=f"{work_path(spark, 'example')}/models",
                      sample_rows=None).first()
    return rounded(TR.input_example(spark, run.model_path).select(*C.GOLD_FEATURES[:8]))


# ---------------------------------------------------------------------------
# Form values -> contract fields (P16), on the part table
# ---------------------------------------------------------------------------

def _part_form(spark, d):
    """``part`` read as submitted forms: size = tenure, price/10 = monthly charge."""
    p = S.table(spark, d, "part")
    size = F.col("p_size")
    return p.select(
        "p_partkey",
        size.alias("tenure_months"), (F.col("p_retailprice") / 10).alias("monthly_charges"),
        (F.col("p_retailprice") * size / 10).alias("total_charges"),
        (size >= 40).cast("int").alias("senior_citizen"), (size % 2).alias("partner"),
        (size % 3 == 0).cast("int").alias("dependents"), F.lit(1).alias("phone_service"),
        (size % 5 != 0).cast("int").alias("paperless_billing"), (size % 7 < 3).cast("int").alias("gender_male"),
        F.when(size % 3 == 0, "dsl").when(size % 3 == 1, "fiber optic").otherwise("no").alias("internet_service"),
        F.when(size < 12, "month-to-month").when(size < 30, "one year").otherwise("two year").alias("contract_type"),
        F.lower(F.when(F.col("p_type") == "ECONOMY", "Electronic check").when(F.col("p_type") == "SMALL", "Mailed check")
                 .when(F.col("p_type") == "LARGE", "Bank transfer").otherwise("Credit card")).alias("payment_method"))


_FORM_SQL = """
SELECT p_partkey, p_size AS tenure_months, p_retailprice / 10 AS monthly_charges,
  p_retailprice * p_size / 10 AS total_charges,
  CAST(p_size >= 40 AS INTEGER) AS senior_citizen, p_size % 2 AS partner, CAST(p_size % 3 = 0 AS INTEGER) AS dependents,
  1 AS phone_service, CAST(p_size % 5 <> 0 AS INTEGER) AS paperless_billing, CAST(p_size % 7 < 3 AS INTEGER) AS gender_male,
  CASE WHEN p_size % 3 = 0 THEN 'dsl' WHEN p_size % 3 = 1 THEN 'fiber optic' ELSE 'no' END AS internet_service,
  CASE WHEN p_size < 12 THEN 'month-to-month' WHEN p_size < 30 THEN 'one year' ELSE 'two year' END AS contract_type,
  lower(CASE WHEN p_type = 'ECONOMY' THEN 'Electronic check' WHEN p_type = 'SMALL' THEN 'Mailed check'
             WHEN p_type = 'LARGE' THEN 'Bank transfer' ELSE 'Credit card' END) AS payment_method
FROM part"""


@register("feature_reshape", f"""
SELECT p_partkey, tenure_months, {r('monthly_charges', 'monthly_charges')}, {r('total_charges', 'total_charges')},
  {r('CASE WHEN tenure_months > 0 THEN total_charges / tenure_months ELSE monthly_charges END', 'avg_charge_per_month')},
  senior_citizen, partner, dependents, phone_service, paperless_billing, gender_male,
  CAST(tenure_months >= {C.LONG_TENURE_MONTHS} AS INTEGER) AS is_long_tenure,
  CAST(monthly_charges >= {C.HIGH_SPENDER_MONTHLY} AS INTEGER) AS is_high_spender,
  {", ".join(f"CAST({c} = '{v}' AS INTEGER) AS {c}_{v.replace(' ', '_').replace('-', '_')}"
             for c, vals in C.ONE_HOT_VOCABULARY.items() for v in vals)}
FROM ({_FORM_SQL}) f""")
def q_feature_reshape(spark, d):
    from ..operators.features import form_to_features

    return rounded(form_to_features(_part_form(spark, d), keep=("p_partkey",)))
