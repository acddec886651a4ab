"""Incremental ingest: the stream remembers processed files."""

from pyspark.sql import functions as F

from tessera import config as C
from tessera.streaming.bronze import ingest_available

from .conftest import DIRTY_CSV, SAMPLE_CSV, write_text

ONE_ROW = SAMPLE_CSV.splitlines()[0] + "\nC0030,Male,0,No,No,5,Yes,DSL,Month-to-month,Yes,Mailed check,20.00,100.00,No\n"


def test_second_run_reads_only_new_files(spark, tmp_path):
    d = str(tmp_path)
    land, bronze, ck = f"{d}/landing", f"{d}/bronze", f"{d}/_ck"
    write_text(land, "a.csv", SAMPLE_CSV)
    write_text(land, "b.csv", DIRTY_CSV)
    first = ingest_available(spark, land, bronze, ck)
    assert first["input_rows"] == 24
    b = spark.read.parquet(bronze)
    assert b.count() == 24 and b.filter(F.col("_corrupt_record").isNotNull()).count() == 2
    write_text(land, "c.csv", ONE_ROW)
    second = ingest_available(spark, land, bronze, ck)
    assert second["input_rows"] == 1
    assert spark.read.parquet(bronze).count() == 25
    third = ingest_available(spark, land, bronze, ck)
    assert third["input_rows"] == 0


def test_schema_tracking_widens_for_new_files(spark, tmp_path):
    from tessera.sources.landing import table_columns
    from tessera.streaming.bronze import ingest_tracking_schema

    d = str(tmp_path)
    land, bronze, ck, sl = f"{d}/landing", f"{d}/bronze", f"{d}/_ck", f"{d}/_schema"
    write_text(land, "a.csv", SAMPLE_CSV)
    first = ingest_tracking_schema(spark, land, bronze, ck, sl)
    assert first["input_rows"] == 20 and "segment" not in first["columns"]
    wide = SAMPLE_CSV.splitlines()[0] + ",segment\nC0031,Male,0,No,No,5,Yes,DSL,Month-to-month,Yes,Mailed check,20.00,100.00,No,retail\n"
    write_text(land, "b.csv", wide)
    second = ingest_tracking_schema(spark, land, bronze, ck, sl)
    assert second["input_rows"] == 1 and second["columns"][-1] == "segment"
    noted = spark.read.parquet(sl)
    assert noted.count() == 2 and table_columns([r.header for r in noted.collect()])[-2:] == ("churn", "segment")
    b = spark.read.option("mergeSchema", "true").parquet(bronze)
    assert b.count() == 21
    assert b.filter(F.col("segment") == "retail").select("customer_id").first()[0] == "C0031"
    assert b.filter(F.col("_corrupt_record").isNotNull()).count() == 0


def test_held_back_windows_come_with_a_later_batch(spark, tmp_path):
    from collections import Counter

    from tessera.streaming.alerts import run_alert_stream
    from tessera.streaming.ops import run_to_parquet, windowed_counts

    d, start, delay = str(tmp_path), 1_700_000_040 // 60 * 60, 600
    schema = "ts timestamp, http_path string, status_code int"

    def put(rows):
        spark.createDataFrame([(start + s, p, c) for s, p, c in rows], "s long, http_path string, status_code int") \
            .select(F.timestamp_seconds("s").alias("ts"), "http_path", "status_code").coalesce(1).write.mode("append").parquet(f"{d}/log")

    def run():
        log = lambda: spark.readStream.schema(schema).parquet(f"{d}/log")
        run_to_parquet(windowed_counts(log(), "10 minutes"), f"{d}/out", f"{d}/_ck")
        run_alert_stream(spark, log(), f"{d}/alerts", f"{d}/_ck_alerts")
        out = spark.read.parquet(f"{d}/out").select(F.col("window_end").cast("long"), "http_path", "requests", "errors").collect()
        fired = spark.read.parquet(f"{d}/alerts").select(F.col("fires_at").cast("long")).collect()
        return sorted(map(tuple, out)), sorted(r[0] for r in fired)

    def want(rows):
        """Windows and alert instants up to the last watermark."""
        n, bad = Counter(), Counter()
        for s, path, code in rows:
            for k in range(1, 6):
                end = start + s // 60 * 60 + 60 * k
                for key in ((end, path), end):
                    n[key] += 1
                    bad[key] += code >= 500
        closed = start + max(s for s, *_ in rows) - delay
        red = {e for e in n if isinstance(e, int) and bad[e] / n[e] > C.ERROR_RATIO_RED}
        fired = sorted(e for e in red if e <= closed and all(e - 60 * k in red for k in range(6)))
        return sorted((*k, n[k], bad[k]) for k in n if isinstance(k, tuple) and k[0] <= closed), fired

    # errors from minute 6 on; silence from minute 12 to 20
    first = [(60 * m + 7 * k, "/a" if k % 3 else "/b", 500 if m >= 6 and k == 4 else 200)
             for m in range(40) if not 12 <= m < 20 for k in range(8)]
    put(first)
    windows, fired = run()
    assert (windows, fired) == want(first)
    # rows that are late, but above the watermark; then one that passes all of the first batch
    second = [(60 * 36 + 1, "/a", 500), (60 * 33 + 2, "/b", 200), (60 * 100, "/a", 200)]
    put(second)
    later = run()
    assert later == want(first + second)
    last = start + 60 * 39 + 49
    assert max(w[0] for w in windows) <= last - delay and max(fired) <= last - delay
    assert {w[0] for w in later[0]} >= {last // 60 * 60 + 60 * k for k in range(-9, 6)}
    assert max(later[1]) > last - delay


def test_alert_instants_are_dealt_by_instant(spark, tmp_path):
    from tessera.streaming.alerts import evaluation_windows, held_alert_stream

    log = spark.readStream.schema("ts timestamp, http_path string, status_code int").parquet(str(tmp_path))
    plan = held_alert_stream(evaluation_windows(log))._jdf.queryExecution().analyzed().toString()
    assert "TransformWithState" not in plan and "FlatMapGroups" not in plan
    assert plan.count("Aggregate [") == 3
