"""Golden tests of Bronze -> Silver -> Gold on the 20-row sample (values from FIXTURES.md)."""

import pytest
from pyspark.sql import functions as F

from tessera import config as C
from tessera.functions.scoring import rule_prediction
from tessera.operators import evaluate as EV
from tessera.operators.clean import silver_from_bronze
from tessera.operators.features import gold_features, split_counts
from tessera.operators.quality import QualityGateError, enforce_gates, quality_report
from tessera.sources.landing import read_landing

from .conftest import DIRTY_CSV, SAMPLE_CSV, write_text


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("landing"))
    write_text(d, "customer_churn_raw.csv", SAMPLE_CSV)
    bronze = read_landing(spark, d).cache()
    silver, quarantine = silver_from_bronze(bronze)
    silver = silver.cache()
    gold = gold_features(silver).cache()
    return bronze, silver, quarantine, gold


def test_layer_counts(layers):
    bronze, silver, quarantine, gold = layers
    assert bronze.count() == 20
    assert silver.count() == 20 and silver.select("customer_id").distinct().count() == 20
    assert quarantine.count() == 0
    assert gold.count() == 20


def test_gold_schema_order(layers):
    gold = layers[3]
    assert len(gold.columns) == 25
    assert gold.columns[0] == "customer_id" and gold.columns[-1] == "_split"
    feats = [c for c in gold.columns if c not in ("customer_id", "churn", "_split")]
    assert sorted(feats) == sorted(C.GOLD_FEATURES)


def test_golden_aggregates(layers):
    s, g = layers[1], layers[3]
    row = g.agg(
        F.sum("churn").alias("churn1"), F.sum("gender_male").alias("male"), F.sum("senior_citizen").alias("senior"),
        F.sum("partner").alias("partner"), F.sum("dependents").alias("dep"), F.sum("phone_service").alias("phone"),
        F.sum("paperless_billing").alias("paperless"), F.sum("internet_service_dsl").alias("dsl"),
        F.sum("internet_service_fiber_optic").alias("fiber"), F.sum("internet_service_no").alias("no_inet"),
        F.sum("contract_type_month_to_month").alias("m2m"), F.sum("contract_type_one_year").alias("one"),
        F.sum("contract_type_two_year").alias("two"), F.sum("payment_method_electronic_check").alias("echeck"),
        F.sum("payment_method_mailed_check").alias("mailed"), F.sum("payment_method_bank_transfer").alias("bank"),
        F.sum("payment_method_credit_card").alias("card"), F.sum("is_long_tenure").alias("long"),
        F.sum("is_high_spender").alias("high"), F.sum("tenure_months").alias("tenure"),
        F.round(F.sum("monthly_charges"), 2).alias("monthly"), F.round(F.sum("total_charges"), 2).alias("total"),
        F.round(F.sum("avg_charge_per_month"), 6).alias("avg")).first()
    assert (row.churn1, row.male, row.senior, row.partner, row.dep, row.phone, row.paperless) == (8, 10, 5, 11, 7, 18, 14)
    assert (row.dsl, row.fiber, row.no_inet) == (6, 14, 0)
    assert (row.m2m, row.one, row.two) == (10, 5, 5)
    assert (row.echeck, row.mailed, row.bank, row.card) == (8, 2, 5, 5)
    assert (row.long, row.high, row.tenure) == (9, 14, 570)
    assert (row.monthly, row.total) == (1659.60, 55217.60)
    assert row.avg == pytest.approx(1665.694476, abs=1e-6)


def test_split_golden(layers):
    g = layers[3]
    counts = {r["_split"]: r["n_rows"] for r in split_counts(g).collect()}
    assert counts == {"train": 17, "val": 1, "test": 2}
    assert [r.customer_id for r in g.filter("_split = 'val'").collect()] == ["C0005"]
    assert sorted(r.customer_id for r in g.filter("_split = 'test'").collect()) == ["C0006", "C0011"]


def test_rule_predictor_matches_label(layers):
    g = layers[3].withColumn("p", rule_prediction())
    assert g.filter(F.col("p.prediction") == 1).count() == 8
    assert g.filter(F.col("p.prediction") != F.col("churn")).count() == 0


def test_single_class_validation_auc_guard(layers):
    g = layers[3].withColumn("score", F.col("tenure_months").cast("double"))
    auc = EV.roc_auc(g.filter("_split = 'val'"), "churn", "score").first()
    assert auc.auc == 0.0


def test_gates(layers, spark):
    enforce_gates(quality_report(layers[1], "customer_id"))
    dup = layers[1].unionByName(layers[1].limit(1))
    with pytest.raises(QualityGateError):
        enforce_gates(quality_report(dup, "customer_id"))
    with pytest.raises(QualityGateError):
        enforce_gates(quality_report(layers[1].limit(0), "customer_id"))


def test_dirty_file(spark, tmp_path):
    d = str(tmp_path)
    write_text(d, "a.csv", SAMPLE_CSV)
    write_text(d, "b.csv", DIRTY_CSV)
    bronze = read_landing(spark, d)
    bronze.write.parquet(f"{d}/_bronze")          # materialise, as the Bronze job does
    bronze = spark.read.parquet(f"{d}/_bronze")
    audit = bronze.agg(F.count(F.lit(1)), F.count("_corrupt_record"), F.countDistinct("_ingest_ts"),
                       F.countDistinct("_source_file")).first()
    assert tuple(audit) == (24, 2, 1, 2)
    rescued = bronze.filter(F.col("_rescued_data").isNotNull()).select("_rescued_data").first()[0]
    assert rescued == '{"_c14":"EXTRA"}'
    silver, quarantine = silver_from_bronze(bronze)
    assert quarantine.count() == 3
    reasons = sorted(r._reject_reason for r in quarantine.collect())
    assert reasons == ["corrupt_record", "corrupt_record", "missing_id"]
    assert silver.count() == 21 and silver.select("customer_id").distinct().count() == 21
    c21 = silver.filter("customer_id = 'C0021'").first()
    assert c21.senior_citizen is None and c21.monthly_charges is None and c21.total_charges is None
    assert c21.tenure_months == 0 and c21.churn == 0
    g21 = gold_features(silver).filter("customer_id = 'C0021'").first()
    assert g21.avg_charge_per_month is None


def test_duplicate_ids_same_and_later_batch(spark, tmp_path):
    """Same batch: a tie on _ingest_ts is broken by file then row hash, so the
    winner is stable across runs; later batch: the newer ingest wins."""
    from tessera.streaming.bronze import ingest_available

    d = str(tmp_path)
    header = SAMPLE_CSV.splitlines()[0]
    row = SAMPLE_CSV.splitlines()[1]                                 # C0001 ... 75.50,906.00,No
    twin = row.replace("75.50,906.00,No", "80.00,960.00,Yes")
    write_text(f"{d}/landing", "a.csv", "\n".join([header, row, twin]) + "\n")
    ingest_available(spark, f"{d}/landing", f"{d}/bronze", f"{d}/_ck", max_files_per_trigger=1)
    winners = set()
    for _ in range(2):
        silver, _ = silver_from_bronze(spark.read.parquet(f"{d}/bronze"))
        rows = silver.collect()
        assert len(rows) == 1
        winners.add((rows[0].monthly_charges, rows[0].churn))
    assert len(winners) == 1                                         # deterministic tie-break
    later = row.replace("75.50,906.00,No", "99.99,999.99,Yes")
    write_text(f"{d}/landing", "b.csv", "\n".join([header, later]) + "\n")
    ingest_available(spark, f"{d}/landing", f"{d}/bronze", f"{d}/_ck", max_files_per_trigger=1)
    silver, _ = silver_from_bronze(spark.read.parquet(f"{d}/bronze"))
    r = silver.first()
    assert (r.monthly_charges, r.churn) == (99.99, 1)
