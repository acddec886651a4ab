"""Batch and stream scoring.

The service scored one request per call; here a DataFrame of records goes
through the contract (V5-V9), the predictor and the envelope in one plan.
MLlib models score inside the JVM; foreign models plug in through
``pandas_predictor`` (Arrow batches, model loaded once per Python worker).
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import work_path
from ..sources.tables import write_text
from ..functions.scoring import envelope, interpret_score, request_id, rule_prediction
from .quality import apply_contract, output_contract_ok, split_by


def score_rule(df: DataFrame) -> DataFrame:
    """Rule predictor over a DataFrame of records."""
    return df.withColumn("_pred", rule_prediction())


def score_model(df: DataFrame, model: PipelineModel, threshold: float = 0.5) -> DataFrame:
    """MLlib pipeline predictor (C2): the positive-class probability goes through
    ``interpret_score`` so a class-only model still yields a valid envelope."""
    out = model.transform(df)
    p1 = vector_to_array(F.col("probability")).getItem(1)
    keep = [c for c in df.columns]
    return out.select(*keep, interpret_score(p1, threshold).alias("_pred"))


# Models loaded by ``pandas_predictor``, per Python worker process (workers are reused).
_WORKER_MODELS: dict = {}


def pandas_predictor(df: DataFrame, load: Callable[[], object], features, out_col: str = "_score",
                     model_key: str | None = None) -> DataFrame:
    """Vectorised foreign-model hook (U1): ``load()`` runs once per Python worker
    process (cached under ``model_key``); ``model.predict(pdf[features])`` runs
    per Arrow batch."""
    feats = list(features)
    key = model_key or f"{getattr(load, '__module__', '')}.{getattr(load, '__qualname__', repr(load))}"

    def run(it):
        from tessera.operators import score as _self

        model = _self._WORKER_MODELS.get(key)
        if model is None:
            model = _self._WORKER_MODELS[key] = load()
        for pdf in it:
            pdf[out_col] = pd.Series(model.predict(pdf[feats])).astype("float64").values
            yield pdf

    # a new StructType: StructType.add would mutate the frame's cached schema
    schema = T.StructType(list(df.schema.fields) + [T.StructField(out_col, T.DoubleType())])
    scored = df.mapInPandas(run, schema)
    return scored.withColumn("_pred", interpret_score(F.col(out_col))).drop(out_col)


class LinearModel:
    """A foreign model: logistic of a weighted sum, as a service outside Spark would ship it (a small JSON file)."""

    def __init__(self, weights: dict[str, float], bias: float) -> None:
        self.weights, self.bias = weights, bias

    def predict(self, pdf: pd.DataFrame) -> pd.Series:
        score = sum((w * pdf[c].astype(float) for c, w in self.weights.items()), pd.Series(self.bias, index=pdf.index, dtype=float))
        return 1 / (1 + np.exp(-score))


def ship_artifact(spark: SparkSession, name: str, content: str) -> str:
    """Put a model file on every executor: written to the shared folder, fetched by each executor once (``addFile``)."""
    path = f"{work_path(spark, 'artifacts')}/{name}"
    write_text(spark, path, content)
    spark.sparkContext.addFile(path)
    return name


def shipped_linear_model(name: str, loads=None) -> Callable[[], LinearModel]:
    """Loader of a shipped linear model; ``loads`` (an accumulator) counts how often workers load it."""
    def load() -> LinearModel:
        with open(SparkFiles.get(name)) as f:
            spec = json.load(f)
        if loads is not None:
            loads.add(1)
        return LinearModel(spec["weights"], spec["bias"])

    return load


def envelope_of(scored: DataFrame, key: str, model_version: str, model_name: str, keep=()) -> DataFrame:
    """Prediction envelope per record (C3) plus the output-contract flag."""
    cols = [F.col(k) for k in keep] + envelope(F.col("_pred"), model_version, model_name,
                                               request_id(F.col(key)))
    return scored.select(*cols).withColumn("output_ok", output_contract_ok())


def contract_then_score(records: DataFrame, keep, predictor=score_rule):
    """Contract first (V5-V9): (valid records scored, rejected records with errors)."""
    checked = apply_contract(records, keep=tuple(keep))
    bad, good = split_by(checked, F.size("_errors") > 0)
    return predictor(good.drop("_errors")), bad


def choose_predictor(mock: bool, registry=None, name: str | None = None, alias: str = "production"):
    """Predictor by configuration (C4): the rule predictor when ``mock``, else the
    model registered as ``name@alias``.  Returns (predict function, envelope
    metadata)."""
    if mock:
        return score_rule, {"model_name": "mock", "model_version": "0"}
    from .registry import load_by_alias

    model, version = load_by_alias(registry, name, alias)
    return (lambda df: score_model(df, model)), {"model_name": name, "model_version": version}
