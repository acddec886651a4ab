"""Queries over real landing files: stream ingest, corrupt capture, manifest,
idempotent quarantine, versioned overwrite, schema merge/evolution, upsert
(S1-S15, S20, R1-R3).  Files go below the shared checkpoint folder, one
fresh folder per run."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..operators import clean as CL
from ..operators import quality as QA
from ..session import work_path
from ..sources import landing as L
from ..sources import tables as TB
from ..streaming.bronze import ingest_available, ingest_tracking_schema
from ..streaming.silver import run_silver_stream
from . import standins as S
from .queries import (round6, GOLD_DOUBLES, LATEST_SQL, ORDER_COLS, ROUND, SILVER_SQL, _QUAR_SQL, _quarantine_view,
                      gold_body_sql, gold_sql, r, register, rounded)

HEADER = ",".join(C.RAW_COLUMNS)


def _lines(text, malformed: bool = False):
    line = L.to_csv_line(C.RAW_COLUMNS)
    if malformed:
        k = F.col("c_custkey")
        short = L.to_csv_line(C.RAW_COLUMNS[:11])          # last three fields missing
        line = (F.when(k % 71 == 0, short)
                 .when(k % 73 == 0, F.concat(line, F.lit(",EXTRA")))   # one surplus token
                 .otherwise(line))
    return text.select(line.alias("line"))


def _updates(text):
    """Second landing batch: the partner customers (balance >= 5000) again, with
    new charges and churn -- a data-driven change set, not an id sample."""
    return (text.filter(F.col("partner") == "Yes")
                .withColumns({"monthly_charges": (F.col("monthly_charges").try_cast("double") + 1).cast("string"),
                              "churn": F.lit("Yes")}))


def land(spark, d, root, dirty=False, malformed=False, updates=False):
    text = S.churn_text(spark, d, dirty)
    L.write_landing(_lines(text, malformed), f"{root}/0001", HEADER)
    if updates:
        L.write_landing(_lines(_updates(text)), f"{root}/0002", HEADER)
    return text


def _bronze_view(b):
    return b.select(*[c for c in C.RAW_COLUMNS if c not in ("monthly_charges", "total_charges")],
                    round6(F.col("monthly_charges").try_cast("double")).alias("monthly_value"),
                    round6(F.col("total_charges").try_cast("double")).alias("total_value"),
                    F.col(L.CORRUPT).isNotNull().cast("int").alias("is_corrupt"))


_TEXT_SQL = f"""
SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS customer_id, gender, senior_citizen, partner, dependents,
  CAST(tenure AS VARCHAR) AS tenure_months, phone_service, internet_service, contract_type, paperless_billing,
  payment_method, monthly, total, churn
FROM ({S.CHURN_TYPED_SQL}) t"""
_UPDATE_SQL = f"""
SELECT * REPLACE (monthly + 1 AS monthly, 'Yes' AS churn) FROM ({_TEXT_SQL}) u WHERE partner = 'Yes'"""


def _bronze_view_sql(src):
    return f"""
SELECT customer_id, gender, senior_citizen, partner, dependents, tenure_months, phone_service, internet_service,
  contract_type, paperless_billing, payment_method, churn, {r('monthly', 'monthly_value')},
  {r('total', 'total_value')}, 0 AS is_corrupt FROM ({src}) s"""


@register("bronze_stream_ingest", f"{_bronze_view_sql(_TEXT_SQL)} UNION ALL {_bronze_view_sql(_UPDATE_SQL)}")
def q_bronze_stream_ingest(spark, d):
    root = work_path(spark, "bronze_stream")
    land(spark, d, f"{root}/landing", updates=True)
    ingest_available(spark, f"{root}/landing/*", f"{root}/bronze", f"{root}/_checkpoint/bronze",
                     max_files_per_trigger=2)
    return _bronze_view(spark.read.parquet(f"{root}/bronze"))


@register("bronze_audit", """
SELECT count(*) + (SELECT count(*) FROM customer WHERE c_acctbal >= 5000) AS total_rows,
       0::BIGINT AS corrupt_rows, 0::BIGINT AS files_missed
FROM customer""")
def q_bronze_audit(spark, d):
    """The notebook's verify query: rows, corrupt rows, latest ingest, and landed
    files that Bronze does not name (A1).
    ``latest_ingest`` is checked for presence only (a clock value)."""
    root = work_path(spark, "bronze_audit")
    land(spark, d, f"{root}/landing", updates=True)
    ingest_available(spark, f"{root}/landing/*", f"{root}/bronze", f"{root}/_checkpoint/bronze")
    b = spark.read.parquet(f"{root}/bronze")
    landed = L.landing_manifest(spark, f"{root}/landing").count()
    return b.agg(F.count(F.lit(1)).alias("total_rows"), F.count(L.CORRUPT).alias("corrupt_rows"),
                 F.max("_ingest_ts").alias("latest_ingest"),
                 (F.lit(landed) - F.count_distinct("_source_file")).alias("files_missed")).drop("latest_ingest")


@register("corrupt_capture", """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
  CASE WHEN c_custkey % 71 = 0 THEN NULL ELSE churn END AS churn,
  CAST(c_custkey % 71 = 0 OR c_custkey % 73 = 0 AS INTEGER) AS is_corrupt,
  CASE WHEN c_custkey % 71 <> 0 AND c_custkey % 73 = 0 THEN '{"_c14":"EXTRA"}' END AS _rescued_data
FROM (""" + S.CHURN_TYPED_SQL + ") t")
def q_corrupt_capture(spark, d):
    root = work_path(spark, "corrupt")
    land(spark, d, f"{root}/landing", malformed=True)
    # Bronze is materialised with every column before it is queried: with CSV
    # column pruning a surplus token is not detected when few columns are read.
    L.read_landing(spark, f"{root}/landing/*").write.parquet(f"{root}/bronze")
    b = spark.read.parquet(f"{root}/bronze")
    return b.select("customer_id", "churn", F.col(L.CORRUPT).isNotNull().cast("int").alias("is_corrupt"),
                    "_rescued_data")


@register("landing_manifest", """
SELECT '0001' AS batch, count(*) AS feed_rows, 0::BIGINT AS unread_files, 0::BIGINT AS unlisted_files,
  0::BIGINT AS unsized_files FROM customer
UNION ALL SELECT '0002', count(*), 0, 0, 0 FROM customer WHERE c_acctbal >= 5000 HAVING count(*) > 0""")
def q_landing_manifest(spark, d):
    """The listing against the rows read, per batch folder: every listed file is read,
    every file read is listed with a size and a time (S15)."""
    root = work_path(spark, "manifest")
    land(spark, d, f"{root}/landing", updates=True)

    def plain(path):                                   # file:/x and file:///x are one path
        return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")

    listed = L.landing_manifest(spark, f"{root}/landing").withColumn("path", plain("path"))
    read = (L.read_landing(spark, f"{root}/landing/*").groupBy(plain("_source_file").alias("path"))
             .agg(F.count(F.lit(1)).alias("n")))
    both = listed.join(read, "path", "full")
    return both.groupBy(F.regexp_extract("path", r"/(\d{4})/[^/]*$", 1).alias("batch")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("feed_rows"), F.count_if(F.col("n").isNull()).alias("unread_files"),
        F.count_if(F.col("length").isNull()).alias("unlisted_files"),
        F.count_if(~(F.col("length") > 0) | F.col("modificationTime").isNull()).alias("unsized_files"))


@register("quarantine_idempotent", _QUAR_SQL)
def q_quarantine_idempotent(spark, d):
    root = work_path(spark, "quarantine")
    land(spark, d, f"{root}/landing", dirty=True)
    qpath = f"{root}/quarantine"
    for _ in range(2):                                     # the second run must add nothing
        bronze = L.read_landing(spark, f"{root}/landing/*")
        bad, _ = QA.quarantine_split(bronze)
        bad = bad.withColumn("_q_hash", F.xxhash64(*[F.col(c) for c in C.RAW_COLUMNS + (L.CORRUPT,)]))
        TB.append_new(spark, qpath, bad, ["_source_file", "_q_hash"])
    return _quarantine_view(TB.read_merged(spark, qpath))


@register("versioned_overwrite", f"""
SELECT customer_id, 2 AS version, {r('monthly_charges', 'monthly_charges')},
  {r('CASE WHEN tenure_months > 0 THEN total_charges / tenure_months ELSE monthly_charges END',
     'avg_charge_per_month')}
FROM ({SILVER_SQL}) s""")
def q_versioned_overwrite(spark, d):
    from .queries import silver_churn

    ds = TB.VersionedDataset(spark, work_path(spark, "silver_versions"))
    silver = silver_churn(spark, d)
    ds.write(silver.select("customer_id", "monthly_charges"))
    v1 = ds.read()                                         # read the table we are about to replace
    widened = v1.join(silver.select("customer_id", "tenure_months", "total_charges"), "customer_id")
    v = ds.write(widened.select("customer_id", "monthly_charges", F.when(
        F.col("tenure_months") > 0, F.col("total_charges") / F.col("tenure_months"))
        .otherwise(F.col("monthly_charges")).alias("avg_charge_per_month")))
    cur = ds.read()
    return cur.select("customer_id", F.lit(v).alias("version"),
                      round6("monthly_charges").alias("monthly_charges"),
                      round6("avg_charge_per_month").alias("avg_charge_per_month"))


@register("schema_evolution_merge", """
SELECT o_orderkey, o_custkey, round(o_totalprice, 6) AS o_totalprice, NULL::VARCHAR AS o_orderpriority
FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL
SELECT o_orderkey, o_custkey, round(o_totalprice, 6) AS o_totalprice, o_orderpriority
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def q_schema_evolution_merge(spark, d):
    root = work_path(spark, "merge")
    o = S.table(spark, d, "orders")
    old = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    o.filter(old).select("o_orderkey", "o_custkey", "o_totalprice").write.parquet(f"{root}/part=a")
    o.filter(~old).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority").write.parquet(f"{root}/part=b")
    m = TB.read_merged(spark, root)
    return m.select("o_orderkey", "o_custkey", round6("o_totalprice").alias("o_totalprice"), "o_orderpriority")


# the feed again in other layouts: (columns of the header, quoted header)
_WIDE = C.RAW_COLUMNS + ("segment",)
_EXCHANGED = tuple({"monthly_charges": "total_charges", "total_charges": "monthly_charges"}.get(c, c) for c in C.RAW_COLUMNS)


@register("csv_schema_evolution", f"""
WITH base AS (SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS customer_id, churn, partner, monthly, total
              FROM ({_TEXT_SQL}) t)
SELECT customer_id, churn, NULL::VARCHAR AS segment, 'narrow' AS layout, {r('monthly', 'monthly_value')},
       {r('total', 'total_value')}, 0 AS is_corrupt FROM base
UNION ALL
SELECT customer_id, 'Yes', c_mktsegment, 'wide', {r('monthly + 1', 'monthly_value')}, {r('total', 'total_value')}, 0
FROM base JOIN customer USING (c_custkey) WHERE partner = 'Yes'
UNION ALL
SELECT customer_id, 'Yes', NULL, layout, {r('monthly + 1', 'monthly_value')}, {r('total', 'total_value')}, 0
FROM base, (VALUES ('again'), ('exchanged'), ('quoted')) v(layout) WHERE partner = 'Yes'""")
def q_csv_schema_evolution(spark, d):
    """Five layouts through the tracked stream: narrow, wide, narrow again, two columns exchanged, quoted header."""
    root = work_path(spark, "csv_evolution")
    text = S.churn_text(spark, d)
    seg = S.table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    upd = _updates(text).join(seg, "c_custkey")

    def put(name, rows, columns, quoted=False):
        header = ",".join(f'"{c}"' if quoted else c for c in columns)
        L.write_landing(rows.select(L.to_csv_line(columns).alias("line")), f"{root}/landing/{name}", header)

    def ingest():
        ingest_tracking_schema(spark, f"{root}/landing", f"{root}/bronze", f"{root}/_checkpoint", f"{root}/_layouts")

    put("narrow", text, C.RAW_COLUMNS)
    ingest()
    put("wide", upd, _WIDE)
    put("again", upd, C.RAW_COLUMNS)
    put("exchanged", upd, _EXCHANGED)
    put("quoted", upd, C.RAW_COLUMNS, quoted=True)
    ingest()
    b = TB.read_merged(spark, f"{root}/bronze")
    return b.select("customer_id", "churn", "segment", F.regexp_extract("_source_file", "landing/([a-z]+)/", 1).alias("layout"),
                    round6(F.col("monthly_charges").try_cast("double")).alias("monthly_value"),
                    round6(F.col("total_charges").try_cast("double")).alias("total_value"),
                    F.col(L.CORRUPT).isNotNull().cast("int").alias("is_corrupt"))


@register("upsert_latest", LATEST_SQL)
def q_upsert_latest(spark, d):
    ds = TB.VersionedDataset(spark, work_path(spark, "orders_silver"))
    o = S.table(spark, d, "orders").select(*ORDER_COLS)
    first = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    keys, recency = "o_custkey", ["o_orderdate", "o_orderkey"]
    ds.write(CL.upsert_latest(None, o.filter(first), keys, recency))
    ds.write(CL.upsert_latest(ds.read(), o.filter(~first), keys, recency))
    return ds.read()


@register("upsert_bucketed", LATEST_SQL)
def q_upsert_bucketed(spark, d):
    """Same upsert as ``upsert_latest``, rewriting only the key buckets each batch touches."""
    t = TB.BucketedTable(spark, work_path(spark, "orders_bucketed"), "o_custkey", buckets=8)
    o = S.table(spark, d, "orders").select(*ORDER_COLS)
    first = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    for part in (o.filter(first), o.filter(~first)):
        t.upsert(part, ["o_orderdate", "o_orderkey"])
    return t.read().select(*ORDER_COLS)


@register("upsert_schema_evolution", """
SELECT c_custkey, 2 AS ts, c_mktsegment AS segment
FROM customer WHERE c_nationkey < 12 AND c_acctbal < 5000
UNION ALL SELECT c_custkey, 1, NULL FROM customer WHERE c_nationkey >= 12 AND c_acctbal < 5000
UNION ALL SELECT c_custkey, 3, NULL FROM customer WHERE c_acctbal >= 5000""")
def q_upsert_schema_evolution(spark, d):
    """Three upserts; a column appears in the second, and the third rewrites other rows without it."""
    t = TB.BucketedTable(spark, work_path(spark, "upsert_evolution"), "c_custkey", buckets=8)
    c = S.table(spark, d, "customer")
    t.upsert(c.select("c_custkey", F.lit(1).alias("ts")), ["ts"])
    t.upsert(c.filter("c_nationkey < 12").select("c_custkey", F.lit(2).alias("ts"), F.col("c_mktsegment").alias("segment")), ["ts"])
    t.upsert(c.filter("c_acctbal >= 5000").select("c_custkey", F.lit(3).alias("ts")), ["ts"])
    return t.read().select("c_custkey", "ts", "segment")


@register("silver_stream_upsert", f"""
SELECT customer_id, churn, {r('monthly_charges', 'monthly_charges')}, tenure_months FROM (
  SELECT * REPLACE (CASE WHEN partner = 'yes' THEN monthly_charges + 1 ELSE monthly_charges END AS monthly_charges,
                    CASE WHEN partner = 'yes' THEN 1 ELSE churn END AS churn)
  FROM ({SILVER_SQL}) s) x""")
def q_silver_stream_upsert(spark, d):
    root = work_path(spark, "silver_stream")
    land(spark, d, f"{root}/landing", updates=True)
    ingest_available(spark, f"{root}/landing/*", f"{root}/bronze", f"{root}/_checkpoint/bronze",
                     max_files_per_trigger=1)
    bronze_schema = spark.read.parquet(f"{root}/bronze").schema
    silver = TB.BucketedTable(spark, f"{root}/silver", C.ID_COLUMN, buckets=8)
    run_silver_stream(spark, f"{root}/bronze", bronze_schema, silver, f"{root}/quarantine",
                      f"{root}/_checkpoint/silver")
    s = silver.read()
    return s.select("customer_id", "churn", round6("monthly_charges").alias("monthly_charges"),
                    "tenure_months")


# ---------------------------------------------------------------------------
# The daily job end to end, full rebuild and incremental
# ---------------------------------------------------------------------------

_UPDATED_SILVER_SQL = f"""
SELECT * REPLACE (CASE WHEN partner = 'yes' THEN monthly_charges + 1 ELSE monthly_charges END AS monthly_charges,
                  CASE WHEN partner = 'yes' THEN 1 ELSE churn END AS churn)
FROM ({SILVER_SQL}) s"""
_DAILY_SQL = f"""
SELECT * REPLACE ({", ".join(f"round({c}, {ROUND}) AS {c}" for c in GOLD_DOUBLES)})
FROM ({gold_sql(gold_body_sql(_UPDATED_SILVER_SQL))}) g"""


def _daily(spark, d, incremental: bool):
    """Two days of landing files (base feed, then the update batch) through the
    daily job; returns Gold with the split of the text id."""
    from ..config import JobConfig, Layers
    from .medallion import run_daily

    root = work_path(spark, "daily")
    cfg = JobConfig(layers=Layers(root=f"{root}/lake"))
    text = S.churn_text(spark, d)
    L.write_landing(_lines(text), f"{root}/landing/0001", HEADER)
    run_daily(spark, cfg, f"{root}/landing", incremental=incremental, buckets=8)
    L.write_landing(_lines(_updates(text)), f"{root}/landing/0002", HEADER)
    run_daily(spark, cfg, f"{root}/landing", incremental=incremental, buckets=8)
    if incremental:
        gold = TB.BucketedTable(spark, cfg.layers.path("gold", cfg.gold_table), C.ID_COLUMN, 8).read()
    else:
        gold = TB.VersionedDataset(spark, cfg.layers.path("gold", cfg.gold_table)).read()
    from ..config import GOLD_FEATURES

    cols = [C.ID_COLUMN, *GOLD_FEATURES, C.LABEL_COLUMN, "_split"]
    return rounded(gold.select(*cols))


@register("daily_full", _DAILY_SQL)
def q_daily_full(spark, d):
    return _daily(spark, d, incremental=False)


@register("daily_incremental", _DAILY_SQL)
def q_daily_incremental(spark, d):
    return _daily(spark, d, incremental=True)
