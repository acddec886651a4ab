"""Job-level tests: medallion jobs with versioned writes and rerun idempotence,
layer DDL, header-driven schema evolution, the pandas model hook."""

import numpy as np
from pyspark.sql import functions as F

from tessera.operators.score import pandas_predictor
from tessera.plans.medallion import run_gold, run_silver
from tessera.sources import landing as L
from tessera.sources.tables import VersionedDataset, create_layers

from .conftest import DIRTY_CSV, SAMPLE_CSV, write_text

EXTRA_HEADER = SAMPLE_CSV.splitlines()[0] + ",segment\nC0031,Male,0,No,No,5,Yes,DSL,Month-to-month,Yes,Mailed check,20.00,100.00,No,retail\n"


def test_silver_and_gold_jobs_are_rerunnable(spark, tmp_path):
    d = str(tmp_path)
    write_text(f"{d}/landing", "a.csv", SAMPLE_CSV)
    write_text(f"{d}/landing", "b.csv", DIRTY_CSV)
    bronze_path = f"{d}/bronze"
    L.read_landing(spark, f"{d}/landing").write.parquet(bronze_path)
    silver = VersionedDataset(spark, f"{d}/silver")
    gold = VersionedDataset(spark, f"{d}/gold")
    for run in (1, 2):
        out = run_silver(spark, spark.read.parquet(bronze_path), silver, f"{d}/quarantine")
        assert out["silver_version"] == run and out["silver_rows"] == 21
        # 24 Bronze rows, 2 corrupt; 'maybe' and the short row's missing label are unknown
        assert out["bronze"] == {"bronze_rows": 24, "corrupt_rows": 2, "unknown_labels": 2}
        assert out["quarantined"] == (3 if run == 1 else 0)       # second run appends nothing
        v = run_gold(silver.read(), gold)
        assert v == run
    assert spark.read.parquet(f"{d}/quarantine").count() == 3
    g = gold.read()
    assert g.count() == 21 and set(r["_split"] for r in g.select("_split").distinct().collect()) <= {"train", "val", "test"}
    assert silver.versions() == [1, 2]


def test_layers_ddl(spark):
    rows = sorted(r.schema_name for r in create_layers(spark, "unit").collect())
    assert rows == ["unit_bronze", "unit_gold", "unit_models", "unit_silver"]
    assert create_layers(spark, "unit").count() == 4                       # IF NOT EXISTS


def test_batch_read_binds_columns_by_header(spark, tmp_path):
    d = str(tmp_path)
    write_text(f"{d}/0001", "a.csv", SAMPLE_CSV)
    write_text(f"{d}/0002", "b.csv", EXTRA_HEADER)
    heads = L.file_headers(spark, d)
    assert heads.count() == 2
    assert L.table_columns([r.header for r in heads.collect()])[-1] == "segment"
    df = L.read_evolving(spark, d)
    assert df.count() == 21
    assert df.filter(F.col("segment") == "retail").select("customer_id").first()[0] == "C0031"
    assert df.filter(F.col("_corrupt_record").isNotNull()).count() == 0


def test_header_names():
    assert L.header_names('\ufeff"a b","c,d",,a b, E ') == ("a b", "c,d", "_c2", "a b_3", "E")
    assert L.table_columns(["B,z", "x,a"], ("a", "b")) == ("a", "b", "z", "x")


def test_rescued_tokens_respect_quotes(spark):
    lines = spark.createDataFrame([('"a,b",c,X',), ('a,c',), ("a,,",), ('a,b,"x ""y"", z",',), (None,)], "_corrupt_record string")
    got = [r[0] for r in lines.select(L.rescued_data(2)).collect()]
    assert got == ['{"_c2":"X"}', None, '{"_c2":""}', '{"_c2":"x \\"y\\", z","_c3":""}', None]


def test_stream_binds_columns_by_header(spark, tmp_path):
    """Layouts that change from file to file lose nothing, and only new files are opened."""
    from tessera.streaming import bronze

    d = str(tmp_path)
    args = (spark, f"{d}/landing", f"{d}/bronze", f"{d}/ck", f"{d}/layouts")
    assert bronze.ingest_tracking_schema(*args[:1], str(tmp_path), *args[2:])["input_rows"] == 0
    write_text(f"{d}/landing", "1.csv", "customer_id,total_charges,monthly_charges\nC1,900,75\n\n")
    write_text(f"{d}/landing", "2.csv", '"customer_id","monthly_charges","segment"\nC2,75,"re,tail"\nC3,1,x,MORE\n')
    assert bronze.ingest_tracking_schema(*args)["input_rows"] == 3
    write_text(f"{d}/landing", "3.csv", "customer_id,monthly_charges\nC4,80\nC5\n")
    noted = set(spark.read.parquet(f"{d}/layouts").inputFiles())
    assert bronze.ingest_tracking_schema(*args)["input_rows"] == 2
    new = [f for f in spark.read.parquet(f"{d}/layouts").inputFiles() if f not in noted]
    assert {r.file_path.rsplit("/", 1)[1] for r in spark.read.parquet(*new).collect()} == {"3.csv"}
    rows = {r.customer_id: r for r in spark.read.option("mergeSchema", "true").parquet(f"{d}/bronze").collect()}
    assert len(rows) == 5 and (rows["C1"].monthly_charges, rows["C1"].total_charges) == ("75", "900")
    assert rows["C2"].segment == "re,tail" and rows["C2"]._corrupt_record is None
    assert rows["C3"]._rescued_data == '{"_c3":"MORE"}' and rows["C5"]._corrupt_record == "C5"
    assert rows["C4"].monthly_charges == "80" and rows["C4"].segment is None and rows["C4"]._corrupt_record is None


def test_a_file_without_a_noted_header_stops_the_batch(spark, tmp_path):
    import pytest

    d = str(tmp_path)
    write_text(d, "a.csv", "customer_id\nC1\n")
    lines = L.with_headers(spark.read.text(d), spark.createDataFrame([], "file_path string, header string"))
    with pytest.raises(Exception, match=L.UNKNOWN_LAYOUT):
        L.parse_by_layout(lines, ["customer_id"], ("customer_id",)).collect()


class _Linear:
    """A stand-in foreign model: probability from a fixed linear score."""

    def predict(self, x):
        z = 0.05 * x["monthly_charges"].to_numpy() - 0.1 * x["tenure_months"].to_numpy()
        return 1 / (1 + np.exp(-z))


def test_pandas_predictor_hook(spark):
    df = spark.createDataFrame([(1, 12, 75.5), (2, 2, 99.0), (3, 70, 20.0)],
                               "id int, tenure_months int, monthly_charges double")
    out = {r.id: r._pred for r in pandas_predictor(df, _Linear, ["tenure_months", "monthly_charges"]).collect()}
    assert out[2].prediction == 1 and 0 < out[2].probability < 1
    assert out[3].prediction == 0


def test_run_daily_incremental(spark, tmp_path):
    from tessera.config import JobConfig, Layers
    from tessera.plans.medallion import run_daily
    from tessera.sources.tables import VersionedDataset

    d = str(tmp_path)
    cfg = JobConfig(layers=Layers(root=f"{d}/lake"))
    write_text(f"{d}/landing", "a.csv", SAMPLE_CSV)
    first = run_daily(spark, cfg, f"{d}/landing")
    assert first["ingest"]["input_rows"] == 20 and first["silver"]["silver_rows"] == 20
    write_text(f"{d}/landing", "b.csv", DIRTY_CSV)
    second = run_daily(spark, cfg, f"{d}/landing")
    assert second["ingest"]["input_rows"] == 4            # only the new file
    assert second["silver"]["silver_rows"] == 21 and second["silver"]["quarantined"] == 3
    gold = VersionedDataset(spark, cfg.layers.path("gold", cfg.gold_table)).read()
    assert gold.count() == 21 and second["gold_version"] == 2


def test_bucketed_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    from tessera.sources.tables import BucketedTable

    path = str(tmp_path / "t")
    t = BucketedTable(spark, path, "k", buckets=16)
    base = spark.createDataFrame([(k, 1, f"v{k}") for k in range(200)], "k int, ts int, v string")
    t.upsert(base, ["ts"])
    before = set(t.read().inputFiles())
    upd = spark.createDataFrame([(3, 2, "new"), (500, 2, "added")], "k int, ts int, v string")
    touched = t.upsert(upd, ["ts"])
    assert 1 <= len(touched) <= 2
    rows = {r.k: r.v for r in t.read().collect()}
    assert len(rows) == 201 and rows[3] == "new" and rows[500] == "added" and rows[4] == "v4"
    after = set(t.read().inputFiles())
    untouched = {f for f in before if not any(f"/_bucket={b}/" in f for b in touched)}
    assert untouched and untouched == before & after


def test_a_dead_or_gated_commit_leaves_the_bucketed_table_as_it_was(spark, tmp_path, monkeypatch):
    import pytest

    from tessera.sources import tables as TB

    t = TB.BucketedTable(spark, str(tmp_path / "t"), "k", buckets=4)
    t.upsert(spark.createDataFrame([(k, 1) for k in range(50)], "k int, ts int"), ["ts"])
    newer = spark.createDataFrame([(k, 2) for k in range(60)], "k int, ts int")

    def state():
        return sorted((r.k, r.ts) for r in t.read().collect())

    old = state()

    def refuse(written):
        assert written.count() == 60 and state() == old       # readers see the old table meanwhile
        raise ValueError("gate")

    with pytest.raises(ValueError, match="gate"):
        t.upsert(newer, ["ts"], gate=refuse)
    with monkeypatch.context() as m:
        m.setattr(TB, "_create", lambda *a: (_ for _ in ()).throw(OSError("died before the manifest")))
        with pytest.raises(OSError):
            t.upsert(newer, ["ts"])
    assert state() == old and t.commits() == [1]
    t.upsert(newer, ["ts"])
    assert state() == [(k, 2) for k in range(60)]
    with pytest.raises(FileExistsError):
        TB._create(spark, f"{t.path}/_manifest/{t.commits()[-1]:08d}.json", "{}")
    t.retain(1)
    assert state() == [(k, 2) for k in range(60)] and len(t.commits()) == 1
    assert t.upsert(newer.limit(0), ["ts"]) == [] and len(state()) == 60


def test_failed_gate_version_never_becomes_current(spark, tmp_path):
    import pytest

    from tessera.operators.quality import QualityGateError

    d = str(tmp_path)
    write_text(f"{d}/landing", "a.csv", SAMPLE_CSV)
    bronze = L.read_landing(spark, f"{d}/landing")
    silver = VersionedDataset(spark, f"{d}/silver")
    run_silver(spark, bronze, silver, f"{d}/q")
    empty = bronze.limit(0)
    with pytest.raises(QualityGateError):
        run_silver(spark, empty, silver, f"{d}/q")                 # no rows survive -> gate fails
    assert silver.versions() == [1] and silver.read().count() == 20


def test_choose_predictor_mock_and_registered(spark, tmp_path):
    from tessera.operators import registry as RG
    from tessera.operators.clean import silver_from_bronze
    from tessera.operators.features import gold_features
    from tessera.operators.score import choose_predictor, envelope_of
    from tessera.operators.train import fit_grid

    d = str(tmp_path)
    write_text(f"{d}/landing", "a.csv", SAMPLE_CSV)
    silver, _ = silver_from_bronze(L.read_landing(spark, f"{d}/landing"))
    gold = gold_features(silver).checkpoint(eager=True)

    predict, meta = choose_predictor(True)
    env = envelope_of(predict(gold), "customer_id", meta["model_version"], meta["model_name"], keep=("customer_id",))
    assert env.filter("prediction = 1").count() == 8 and env.filter("output_ok = 1").count() == 20

    reg = RG.Registry(spark, f"{d}/registry")
    reg.log_runs(fit_grid(spark, gold, "random_forest", [{"n_estimators": 5, "max_depth": 2}], "exp",
                          model_root=f"{d}/models"))
    v = reg.register(reg.best_run("exp"), "m")
    reg.set_alias("m", "production", v)
    predict, meta = choose_predictor(False, reg, "m", "production")
    env = envelope_of(predict(gold), "customer_id", meta["model_version"], meta["model_name"], keep=("customer_id",))
    assert meta == {"model_name": "m", "model_version": "1"}
    assert env.count() == 20 and env.filter("output_ok = 1").count() == 20


def test_run_daily_incremental_follows_new_files_only(spark, tmp_path):
    import glob
    import os

    from tessera.config import JobConfig, Layers
    from tessera.plans.medallion import run_daily
    from tessera.sources.tables import BucketedTable

    d = str(tmp_path)
    cfg = JobConfig(layers=Layers(root=f"{d}/lake"))
    write_text(f"{d}/landing", "a.csv", SAMPLE_CSV)
    first = run_daily(spark, cfg, f"{d}/landing", incremental=True, buckets=8)
    silver, gold = (BucketedTable(spark, first[p], "customer_id", 8) for p in ("silver_path", "gold_path"))
    assert silver.read().count() == 20 and gold.read().count() == 20
    before = set(gold.read().inputFiles())
    update = SAMPLE_CSV.splitlines()[0] + "\n" + SAMPLE_CSV.splitlines()[1].replace("75.50,906.00,No", "80.00,960.00,Yes") + "\n"
    write_text(f"{d}/landing", "b.csv", update)
    second = run_daily(spark, cfg, f"{d}/landing", incremental=True, buckets=8)
    assert second["ingest"]["input_rows"] == 1
    assert silver.read().count() == 20 and gold.read().count() == 20
    row = gold.read().filter("customer_id = 'C0001'").first()
    assert (row.monthly_charges, row.churn, row.is_high_spender) == (80.0, 1, 1)
    assert len(before - set(gold.read().inputFiles())) == 1    # one bucket rewritten


def test_versioned_retention_keeps_current(spark, tmp_path):
    ds = VersionedDataset(spark, str(tmp_path / "v"))
    for i in range(4):
        ds.write(spark.range(i + 1))
    assert ds.retain(2) == [1, 2]
    assert ds.versions() == [3, 4] and ds.read().count() == 4
    assert ds.retain(2) == []
