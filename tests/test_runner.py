"""Every stream runner waits through one helper: a query still running is stopped and raised, never read on from."""

import time

import pytest
from pyspark.sql import functions as F

from tessera.sources.tables import BucketedTable
from tessera.streaming import alerts, bronze, ops, scoring, silver
from tessera.streaming.runner import finish, session_setting

from .conftest import SAMPLE_CSV, write_text
from .test_streaming import ONE_ROW


def test_finish_stops_a_running_query(spark, tmp_path):
    query = (spark.readStream.format("rate").load().writeStream.format("noop")
             .option("checkpointLocation", str(tmp_path / "ck")).start())
    with pytest.raises(TimeoutError):
        finish(query, 1)
    assert not query.isActive


@pytest.mark.parametrize("module", [alerts, bronze, ops, scoring, silver])
def test_all_runners_share_the_helper(module):
    assert module.finish is finish


def test_rollup_runner_times_out(spark, tmp_path):
    slow = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    slow = slow.filter(F.udf(lambda v: time.sleep(5) or True, "boolean")("value"))
    with pytest.raises(TimeoutError):
        finish(slow.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck")).start(), 1)


def test_setting_is_restored(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    with pytest.raises(ValueError), session_setting(spark, key, "some.Provider"):
        assert spark.conf.get(key) == "some.Provider"
        raise ValueError
    assert spark.conf.get(key) == before


def test_more_batches_than_progress_is_kept(spark, tmp_path):
    """With three kept progress events, five batches are all counted."""
    d = str(tmp_path)
    for i in range(5):
        write_text(f"{d}/landing", f"{i}.csv", SAMPLE_CSV if i == 0 else ONE_ROW)
    with session_setting(spark, "spark.sql.streaming.numRecentProgressUpdates", "3"):
        out = bronze.ingest_available(spark, f"{d}/landing", f"{d}/bronze", f"{d}/ck", max_files_per_trigger=1)
    assert out["input_rows"] == 24 == spark.read.parquet(f"{d}/bronze").count() and out["batches"] >= 5


def test_a_column_that_appears_later_stays_through_upserts(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), "id", buckets=4)
    table.upsert(spark.createDataFrame([(i, 1, "old") for i in range(40)], "id long, ts int, v string"), ["ts"])
    table.upsert(spark.createDataFrame([(i, 2, "new", "retail") for i in (1, 2)], "id long, ts int, v string, segment string"), ["ts"])
    table.upsert(spark.createDataFrame([(i, 3, "newer") for i in range(3, 40)], "id long, ts int, v string"), ["ts"])
    got = table.read()
    assert got.count() == 40 and {r.id for r in got.filter("segment = 'retail'").collect()} == {1, 2}


def test_an_upsert_writes_few_files(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), "id", buckets=8)
    table.upsert(spark.range(20_000).select("id", F.lit(1).alias("ts")).repartition(8), ["ts"])
    assert len(table.read().inputFiles()) <= 16
