"""Distributed model sweeps on the Gold table.

The notebooks pulled Gold into one pandas frame; here the training set stays a DataFrame.
A forest is an MLlib ``Pipeline``, the network is ``operators.network``; either artifact holds what
prepares its features (M10).  Each grid point is fitted on the train split and evaluated on
validation (and test, reported only); grid points are independent Spark jobs, submitted from a small thread pool, except
that networks with mini-batches of a share of the table descend together (``operators.network``).
"""

from __future__ import annotations

import datetime as dt
import functools
import hashlib
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..sources.tables import list_dirs
from . import evaluate as EV
from . import network as NN

RUNS_SCHEMA = ("run_id string, experiment string, run_name string, family string, "
               "params map<string,string>, metrics map<string,double>, tags map<string,string>, "
               "model_path string, signature string, started_at timestamp")


def _preparation(features) -> list:
    """Stages up to the ``features`` vector (M1).  Mean imputation is fitted on the
    training split and kept in the artifact, so rows with a missing feature are
    still scored (no row is dropped)."""
    cols = [f"{c}__imputed" for c in features]
    return [Imputer(inputCols=list(features), outputCols=cols, strategy="mean"),
            VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep")]


def rf_pipeline(features, label: str, n_estimators: int, max_depth: int, seed: int = 42) -> Pipeline:
    """Random forest (M3): sqrt feature subsets, gini, ``seed`` as in the notebook."""
    return Pipeline(stages=[
        *_preparation(features),
        RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=n_estimators,
                               maxDepth=max_depth, seed=seed, featureSubsetStrategy="sqrt",
                               # more nodes split per pass over the data, fewer passes for deep trees
                               maxMemoryInMB=1024, cacheNodeIds=True, checkpointInterval=10),
    ])


def positive_probability(df: DataFrame, col: str = "probability") -> DataFrame:
    return df.withColumn("prob_1", vector_to_array(F.col(col)).getItem(1))


METRIC_KEYS = ("accuracy", "precision", "recall", "f1", "auc")


def _split_metrics(scored: DataFrame, label: str, threshold: float, splits=("val", "test")) -> dict:
    """Class metrics of ``prob > threshold`` and AUC of ``prob`` for each split, one
    pass over the scored rows of all of them (A5, A6); an empty split reports 0."""
    rows = {r["_split"]: r for r in
            EV.binary_metrics(scored, label, "prob_1", threshold, ["_split"], strict=True).collect()}
    out = {}
    for sp in splits:
        r = rows.get(sp)
        out.update({f"{sp}_{k}": (float(r[k]) if r is not None else 0.0) for k in METRIC_KEYS})
    return out


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _run_id(experiment: str, run_name: str, started: str) -> str:
    return hashlib.sha1(f"{experiment}/{run_name}/{started}".encode()).hexdigest()[:32]


def fit_grid(spark: SparkSession, gold: DataFrame, family: str, grid, experiment: str,
             model_root: str | None = None, label: str = C.LABEL_COLUMN, features=None,
             threshold: float = 0.5, parallelism: int = 3, sample_rows: int | None = 16) -> DataFrame:
    """Fit one model per grid point; returns run rows (M5-M9).  What prepares the features is the
    same at every point: it is fitted once, and the prepared rows are persisted for all points.

    ``threshold``: the notebook's NN used ``prob > 0.5`` (X12).  Metrics of
    the test split are reported as extra keys, never used for selection (X11).

    ``sample_rows``, for networks: the rows of the sample that the grid's ``batch_size`` is meant for; None takes the
    ``batch_size`` as rows of ``gold``, as the notebook does (``operators.network``).
    """
    # The declared contract, not "every other column": a column added upstream by
    # schema evolution must not slip into training unnoticed.
    features = list(features or C.GOLD_FEATURES)
    missing = [f for f in features if f not in gold.columns]
    if missing:
        raise ValueError(f"training input lacks contract features: {missing}")
    labelled = gold.withColumn(label, F.col(label).cast("double"))
    train = labelled.filter(F.col("_split") == "train")
    fits, cached = _forests(labelled, train, features, label) if family == "random_forest" else _networks(labelled, train, features, label, sample_rows)
    grid = list(grid)

    def one(point: int, params: dict, fit):
        started, name, model, scored = fit()
        metrics = _split_metrics(positive_probability(scored), label, threshold)
        run_id = _run_id(experiment, f"{name}/{point}", started.isoformat())  # networks start together
        path = None
        if model_root:
            path = f"{model_root.rstrip('/')}/{run_id}"
            model.save(spark, path) if isinstance(model, NN.NetworkModel) else model.write().overwrite().save(path)
            # input example next to the artifact (M9, K4): the same rows whenever the job is run
            first = [C.ID_COLUMN] if C.ID_COLUMN in train.columns else features
            train.orderBy(*first).select(*features).limit(3).write.mode("overwrite").parquet(f"{path}/_input_example")
        signature = gold.select(*features).schema.json()
        return (run_id, experiment, name, family, {k: str(v) for k, v in params.items()},
                {k: float(v) for k, v in metrics.items()}, {"model_family": family}, path, signature, started)

    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            rows = list(pool.map(one, range(len(grid)), grid, fits(grid, parallelism)))
    finally:
        for df in cached:
            df.unpersist()
    return spark.createDataFrame(rows, RUNS_SCHEMA)


def input_example(spark: SparkSession, path: str) -> DataFrame:
    """The three training rows stored beside a model, as a caller of it would send them (K4)."""
    return spark.read.parquet(f"{path.rstrip('/')}/_input_example")


def _forests(labelled: DataFrame, train: DataFrame, features, label: str):
    """(a fit for each point of a grid, persisted frames) of the forests; a fit gives start, run name, model and scored held-out rows."""
    prepare = Pipeline(stages=_preparation(features)).fit(train)
    ready = prepare.transform(labelled).select(label, "_split", "features").persist()
    ready_train = ready.filter(F.col("_split") == "train")

    held_out = ready.filter(F.col("_split").isin("val", "test"))

    def fit(params: dict):
        started = _now()
        pipe = rf_pipeline(features, label, params["n_estimators"], params["max_depth"])
        # copy(): the copied stages carry no training summary, whose session
        # reference would otherwise ride along in every scoring task
        classifier = pipe.getStages()[-1].fit(ready_train).copy()
        name = f"rf_n{params['n_estimators']}_d{params['max_depth']}"
        return started, name, PipelineModel([*prepare.stages, classifier]), classifier.transform(held_out)

    return lambda grid, parallelism: [functools.partial(fit, params) for params in grid], [ready]


def _networks(labelled: DataFrame, train: DataFrame, features, label: str, sample_rows: int | None):
    """The same of the networks: every parameter of the grid takes part in the fit."""
    key = C.ID_COLUMN if C.ID_COLUMN in labelled.columns else None
    scaling = NN.fit_scaling(train, features)
    if sample_rows is None:
        blocks = NN.training_shards(train, scaling, label, key).persist()
    else:
        blocks = NN.spread(NN.training_blocks(train, scaling, label, key)).persist()
    held_out = labelled.filter(F.col("_split").isin("val", "test")).select(label, "_split", *features).persist()

    def fits(grid, parallelism: int):
        points = [{"sample_rows": sample_rows, **params} for params in grid]
        started, models = _now(), NN.fit_networks(blocks, scaling, points, parallelism=parallelism)
        names = [f"nn_h{params['hidden_units']}_d{params['dropout']}" for params in grid]
        return [functools.partial(lambda name, model: (started, name, model, model.transform(held_out)), *of) for of in zip(names, models)]

    return fits, [blocks, held_out]


def load_model(path: str) -> PipelineModel | NN.NetworkModel:
    spark = SparkSession.active()
    return NN.NetworkModel.load(spark, path) if "network" in list_dirs(spark, path) else PipelineModel.load(path)
