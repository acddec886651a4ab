"""Stand-ins: the driver's tables re-read as the data the pipeline works on.

The test tables hold no churn data, so each operator family gets a
deterministic view of them, written once for Spark and once as DuckDB SQL
(the correctness oracle).  Both texts below must stay in step.

* churn feed  -- ``customer`` joined with per-customer ``orders`` aggregates,
  rendered as the 14 raw text columns of the landing CSV.
* request log -- ``events`` read as the scoring service's request log:
  ``event_type`` is the path, ``'error'`` means status 500 (else 200),
  ``value / 1000`` is the duration in seconds, ``props.k / 1000`` the
  model-call seconds, ``'purchase'`` a positive prediction.
* labelled rows -- ``lineitem`` with label ``l_returnflag = 'R'``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# churn feed
# ---------------------------------------------------------------------------

CHURN_CUTOFF = "2001-01-01 00:00:00"


def order_profile(orders: DataFrame) -> DataFrame:
    """Per-customer order aggregates (partial aggregation before the shuffle)."""
    return orders.groupBy(F.col("o_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
        F.sum("o_totalprice").alias("total_price"),
        F.count_if(F.col("o_orderstatus") == "O").alias("open_orders"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent_orders"),
    )


def churn_feed_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The churn feed before rendering as text (join key ``c_custkey`` kept)."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    prof = order_profile(table(spark, sf_dir, "orders"))
    j = cust.join(prof, cust.c_custkey == prof.o_custkey, "left")
    nat, bal, seg = F.col("c_nationkey"), F.col("c_acctbal"), F.col("c_mktsegment")
    n = F.coalesce(F.col("n_orders"), F.lit(0))
    tenure = ((F.year("last_order") - F.year("first_order")) * 12
              + (F.month("last_order") - F.month("first_order")))
    yn = lambda cond: F.when(cond, F.lit("Yes")).otherwise(F.lit("No"))
    return j.select(
        F.col("c_custkey"),
        F.when(nat % 2 == 0, F.lit("Female")).otherwise(F.lit("Male")).alias("gender"),
        F.when(nat >= 20, F.lit("1")).otherwise(F.lit("0")).alias("senior_citizen"),
        yn(bal >= 5000).alias("partner"),
        yn(F.coalesce(F.col("open_orders"), F.lit(0)) > 0).alias("dependents"),
        tenure.alias("tenure"),
        yn(F.coalesce(F.col("urgent_orders"), F.lit(0)) > 0).alias("phone_service"),
        F.when(seg == "AUTOMOBILE", F.lit("DSL"))
         .when(seg.isin("BUILDING", "HOUSEHOLD"), F.lit("Fiber optic"))
         .when(seg == "MACHINERY", F.lit("No"))
         .otherwise(F.lit("Satellite")).alias("internet_service"),
        F.when(n < 8, F.lit("Month-to-month")).when(n < 12, F.lit("One year"))
         .otherwise(F.lit("Two year")).alias("contract_type"),
        yn(bal < 2500).alias("paperless_billing"),
        F.when(nat % 4 == 0, F.lit("Electronic check")).when(nat % 4 == 1, F.lit("Mailed check"))
         .when(nat % 4 == 2, F.lit("Bank transfer")).otherwise(F.lit("Credit card")).alias("payment_method"),
        (bal / 100).alias("monthly"),
        (F.col("total_price") / 1000).alias("total"),
        yn(F.col("last_order") < F.lit(CHURN_CUTOFF).cast("timestamp_ntz")).alias("churn"),
    )


def render_churn_text(typed: DataFrame, dirty: bool = False) -> DataFrame:
    """Render the typed feed as the 14 raw text columns (+ ``c_custkey``).

    ``dirty`` injects the defects the Silver job must survive, keyed on the
    customer key so the oracle can predict them: NULL id (key % 97 = 0),
    blank id (% 89), unparsable monthly charge (% 83), decimal tenure text
    (% 79), padded mixed-case categories (% 7).  No row is removed.
    """
    k = F.col("c_custkey")
    cid = F.col("c_custkey").cast("string")
    tenure = F.col("tenure").cast("string")
    monthly = F.col("monthly").cast("string")
    gender = F.col("gender")
    contract = F.col("contract_type")
    if dirty:
        cid = F.when(k % 97 == 0, F.lit(None).cast("string")).when(k % 89 == 0, F.lit("   ")).otherwise(
            F.concat(F.lit(" "), cid, F.lit(" ")))
        monthly = F.when(k % 83 == 0, F.lit("abc")).otherwise(monthly)
        tenure = F.when(k % 79 == 0, F.concat(tenure, F.lit(".5"))).otherwise(tenure)
        gender = F.when(k % 7 == 0, F.concat(F.lit("  "), F.upper(gender))).otherwise(gender)
        contract = F.when(k % 7 == 0, F.concat(F.upper(contract), F.lit(" "))).otherwise(contract)
    return typed.select(
        F.col("c_custkey"),
        cid.alias("customer_id"), gender.alias("gender"), F.col("senior_citizen"),
        F.col("partner"), F.col("dependents"), tenure.alias("tenure_months"),
        F.col("phone_service"), F.col("internet_service"), contract.alias("contract_type"),
        F.col("paperless_billing"), F.col("payment_method"), monthly.alias("monthly_charges"),
        F.col("total").cast("string").alias("total_charges"), F.col("churn"),
    )


def churn_text(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    return render_churn_text(churn_feed_typed(spark, sf_dir), dirty)


CHURN_TYPED_SQL = f"""
SELECT c.c_custkey,
  CASE WHEN c.c_nationkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  CASE WHEN c.c_nationkey >= 20 THEN '1' ELSE '0' END AS senior_citizen,
  CASE WHEN c.c_acctbal >= 5000 THEN 'Yes' ELSE 'No' END AS partner,
  CASE WHEN coalesce(p.open_orders, 0) > 0 THEN 'Yes' ELSE 'No' END AS dependents,
  (year(p.last_order) - year(p.first_order)) * 12 + (month(p.last_order) - month(p.first_order)) AS tenure,
  CASE WHEN coalesce(p.urgent_orders, 0) > 0 THEN 'Yes' ELSE 'No' END AS phone_service,
  CASE WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 'DSL'
       WHEN c.c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'Fiber optic'
       WHEN c.c_mktsegment = 'MACHINERY' THEN 'No' ELSE 'Satellite' END AS internet_service,
  CASE WHEN coalesce(p.n_orders, 0) < 8 THEN 'Month-to-month'
       WHEN coalesce(p.n_orders, 0) < 12 THEN 'One year' ELSE 'Two year' END AS contract_type,
  CASE WHEN c.c_acctbal < 2500 THEN 'Yes' ELSE 'No' END AS paperless_billing,
  CASE WHEN c.c_nationkey % 4 = 0 THEN 'Electronic check' WHEN c.c_nationkey % 4 = 1 THEN 'Mailed check'
       WHEN c.c_nationkey % 4 = 2 THEN 'Bank transfer' ELSE 'Credit card' END AS payment_method,
  c.c_acctbal / 100 AS monthly,
  p.total_price / 1000 AS total,
  CASE WHEN p.last_order < TIMESTAMP '{CHURN_CUTOFF}' THEN 'Yes' ELSE 'No' END AS churn
FROM customer c
LEFT JOIN (
  SELECT o_custkey, count(*) AS n_orders, min(o_orderdate) AS first_order,
         max(o_orderdate) AS last_order, sum(o_totalprice) AS total_price,
         count(*) FILTER (WHERE o_orderstatus = 'O') AS open_orders,
         count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent_orders
  FROM orders GROUP BY o_custkey) p ON c.c_custkey = p.o_custkey
"""

# Silver view of the (clean or dirty) feed, as the oracle predicts it: typed,
# normalised, label encoded; the dirty defects resolved as Silver resolves them.
def churn_silver_sql(dirty: bool) -> str:
    if dirty:
        id_expr = ("CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_custkey % 89 = 0 THEN NULL "
                   "ELSE CAST(c_custkey AS VARCHAR) END")
        monthly = "CASE WHEN c_custkey % 83 = 0 THEN NULL ELSE monthly END"
    else:
        id_expr = "CAST(c_custkey AS VARCHAR)"
        monthly = "monthly"
    return f"""
SELECT c_custkey, {id_expr} AS customer_id, lower(gender) AS gender,
  CAST(senior_citizen AS INTEGER) AS senior_citizen, lower(partner) AS partner,
  lower(dependents) AS dependents, CAST(tenure AS INTEGER) AS tenure_months,
  lower(phone_service) AS phone_service, lower(internet_service) AS internet_service,
  lower(contract_type) AS contract_type, lower(paperless_billing) AS paperless_billing,
  lower(payment_method) AS payment_method, {monthly} AS monthly_charges,
  total AS total_charges, CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END AS churn
FROM ({CHURN_TYPED_SQL}) t"""


# ---------------------------------------------------------------------------
# request log (events)
# ---------------------------------------------------------------------------

def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as request log rows: ts, method, path, status, duration (s), predicted class."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("request_seq"),
        F.col("ts"),
        F.lit("POST").alias("http_method"),
        F.concat(F.lit("/"), F.col("event_type")).alias("http_path"),
        F.when(F.col("event_type") == "error", F.lit(500)).otherwise(F.lit(200)).alias("status_code"),
        (F.col("value") / 1000).alias("duration_s"),
        F.when(F.col("event_type") != "error", (F.col("event_type") == "purchase").cast("int")).alias("predicted_class"),
        # model-call latency carried in the JSON props (``k`` milliseconds)
        (F.get_json_object("props", "$.k").try_cast("double") / 1000).alias("inference_s"),
    )


REQUEST_LOG_SQL = """
SELECT event_id AS request_seq, ts, 'POST' AS http_method, '/' || event_type AS http_path,
       CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status_code,
       value / 1000 AS duration_s,
       CASE WHEN event_type <> 'error' THEN CAST(event_type = 'purchase' AS INTEGER) END AS predicted_class,
       TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) / 1000 AS inference_s
FROM events"""


# ---------------------------------------------------------------------------
# labelled rows (lineitem)
# ---------------------------------------------------------------------------

LABEL_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "ship_days")


def labelled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as a labelled set: numeric features, label R, split by order key."""
    from ..functions.features import split_label

    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey"), F.col("l_linenumber"),
        F.col("l_quantity"), F.col("l_extendedprice"), (F.col("l_discount") + 0.0).alias("l_discount"),
        (F.col("l_tax") + 0.0).alias("l_tax"),
        F.datediff(F.col("l_shipdate"), F.lit("1995-01-01").cast("date")).cast("double").alias("ship_days"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        split_label(F.col("l_orderkey")).alias("_split"),
    )
