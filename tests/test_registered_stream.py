"""Streams scored by a model alias, the foreign model's loads, and Silver's schema check."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import config as C
from tessera.operators import network as NN
from tessera.operators import registry as RG
from tessera.operators import score as SC
from tessera.operators.quality import QualityGateError, unexpected_columns
from tessera.operators.train import RUNS_SCHEMA
from tessera.plans.medallion import as_bronze, run_silver
from tessera.plans.queries import gold_churn
from tessera.sources.tables import BucketedTable, VersionedDataset
from tessera.streaming.scoring import run_registered_scoring, score_registered_batch
from tessera.streaming.silver import run_silver_stream

from .conftest import SAMPLE_CSV, SMALL_SF


@pytest.fixture()
def registry(spark, tmp_path):
    reg = RG.Registry(spark, f"{tmp_path}/registry")
    for version, bias in ((1, -50.0), (2, 50.0)):  # one says no, the other yes
        path = f"{tmp_path}/models/{version}"
        NN.NetworkModel(NN.Scaling(["tenure_months"], [0.0], [1.0]), 1, np.array([0.0, 0.0, 0.0, bias])).save(spark, path)
        run = spark.createDataFrame([(str(version), "exp", "r", "neural_network", {}, {"val_f1": 0.5}, {}, path, None, None)], RUNS_SCHEMA)
        reg.log_runs(run)
        reg.register(run, "churn")
    return reg


def test_the_alias_moves_between_batches_and_a_replay_keeps_its_version(spark, registry, tmp_path):
    d = str(tmp_path)
    gold = gold_churn(spark, SMALL_SF).filter("monthly_charges >= 0 AND total_charges >= 0").limit(30).persist()

    def run(part):
        part.write.mode("append").parquet(f"{d}/records")
        run_registered_scoring(spark, registry, "churn", f"{d}/records", gold.schema, f"{d}/out", f"{d}/_ck", C.ID_COLUMN)
        rows = spark.read.parquet(f"{d}/out/scored").collect()
        return {(r.model_version, r.prediction) for r in rows}, len(rows)

    ids = [r[0] for r in gold.select(C.ID_COLUMN).collect()]
    with pytest.raises(Exception, match="does not resolve"):
        run(gold.filter(F.col(C.ID_COLUMN).isin(ids[:10])))
    registry.set_alias("churn", "production", 1)
    seen, n = run(gold.filter(F.col(C.ID_COLUMN).isin(ids[10:20])))
    assert seen == {("1", 0)} and n == 20
    registry.set_alias("churn", "production", 2)
    seen, n = run(gold.filter(F.col(C.ID_COLUMN).isin(ids[20:])))
    assert seen == {("1", 0), ("2", 1)} and n == 30
    # the first batch (planned by the run that failed) is replayed after the alias has moved
    score_registered_batch(registry, f"{d}/out", C.ID_COLUMN, "churn")(gold.filter(F.col(C.ID_COLUMN).isin(ids[:10])), 0)
    again = spark.read.parquet(f"{d}/out/scored").collect()
    assert len(again) == 30 and {(r.model_version, r.prediction) for r in again if r[C.ID_COLUMN] in ids[:20]} == {("1", 0)}


def test_a_foreign_model_is_loaded_once_per_worker(spark):
    loads, workers = spark.sparkContext.accumulator(0), 8
    name = SC.ship_artifact(spark, "linear-test.json", json.dumps({"weights": {"x": 2.0}, "bias": -1.0}))
    df = spark.range(4000).withColumn("x", F.col("id") / 4000).repartition(40)
    out = SC.pandas_predictor(df, SC.shipped_linear_model(name, loads), ["x"], model_key="linear-test").select("id", "_pred.probability").collect()
    assert len(out) == 4000 and all(abs(r.probability - 1 / (1 + np.exp(1 - 2 * r.id / 4000))) < 1e-12 for r in out)
    assert 1 <= loads.value <= workers


def wide(spark, extra):
    header, *rows = SAMPLE_CSV.strip().splitlines()
    text = spark.createDataFrame([tuple(r.split(",")) for r in rows], ", ".join(f"{c} string" for c in header.split(",")))
    return as_bronze(text, extra={"segment": F.when(F.col("customer_id") < "C0005", "retail")} if extra else None)


def test_silver_refuses_undeclared_columns(spark, tmp_path):
    silver = VersionedDataset(spark, f"{tmp_path}/silver")
    with pytest.raises(QualityGateError, match="extra=.'segment'"):
        run_silver(spark, wide(spark, True), silver, f"{tmp_path}/q")
    assert silver.versions() == []
    with pytest.raises(QualityGateError, match="missing=.'churn'"):
        run_silver(spark, wide(spark, False).drop("churn"), silver, f"{tmp_path}/q")
    assert run_silver(spark, wide(spark, True), silver, f"{tmp_path}/q", declared=("segment",))["silver_rows"] == 20
    assert "segment" in silver.read().columns
    done = run_silver(spark, wide(spark, True), silver, f"{tmp_path}/q", extra="quarantine")
    assert done["silver_rows"] == 16 and done["quarantined"] == 4 and "segment" not in silver.read().columns
    aside = spark.read.parquet(f"{tmp_path}/q").collect()
    assert {(r.segment, r._reject_reason) for r in aside} == {("retail", "unexpected_columns")}
    assert run_silver(spark, wide(spark, True), silver, f"{tmp_path}/q", extra="keep")["silver_rows"] == 20
    with pytest.raises(ValueError):
        unexpected_columns(C.RAW_COLUMNS, extra="drop")


def test_the_silver_stream_refuses_undeclared_columns(spark, tmp_path):
    d = str(tmp_path)
    bronze = wide(spark, True)
    bronze.write.parquet(f"{d}/bronze")
    table = BucketedTable(spark, f"{d}/silver", C.ID_COLUMN, 4)
    with pytest.raises(QualityGateError, match="segment"):
        run_silver_stream(spark, f"{d}/bronze", bronze.schema, table, f"{d}/q", f"{d}/_ck")
    run_silver_stream(spark, f"{d}/bronze", bronze.schema, table, f"{d}/q", f"{d}/_ck", extra="quarantine")
    assert table.read().count() == 16 and "segment" not in table.read().columns and spark.read.parquet(f"{d}/q").count() == 4
