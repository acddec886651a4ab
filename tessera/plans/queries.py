"""Registered queries: one Spark plan per operator of the inventory, each paired
with the DuckDB SQL that must give the same rows (``None`` = no SQL form).

Every query reads the driver's tables through ``standins`` and processes all
of their rows.  Doubles are rounded to 6 decimals on both sides so that
summation order cannot flip the value hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import features as FX
from ..operators import clean as CL
from ..operators import features as FE
from ..operators import quality as QA
from . import duck
from . import standins as S
from .medallion import as_bronze

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
ROUND = 6


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def round6(c, scale: int = ROUND):
    """``round(x * 10^s) / 10^s`` in doubles: the same IEEE steps as the SQL
    oracle's ``round(x, s)``, so values on an exact decimal tie round alike."""
    c = F.col(c) if isinstance(c, str) else c
    p = float(10 ** scale)
    return F.round(c * F.lit(p), 0) / F.lit(p)


def rounded(df: DataFrame, scale: int = ROUND) -> DataFrame:
    """Round every double column (keeps names and order)."""
    return df.select(*[round6(F.col(f.name), scale).alias(f.name)
                       if f.dataType.simpleString() == "double" else F.col(f.name)
                       for f in df.schema.fields])


def r(expr: str, alias: str) -> str:
    return f"round({expr}, {ROUND}) AS {alias}"


# ---------------------------------------------------------------------------
# shared Spark building blocks
# ---------------------------------------------------------------------------

def silver_churn(spark, d, dirty=False, strategy="aggregate") -> DataFrame:
    """Churn feed -> Bronze rows -> Silver (no file round trip)."""
    text = S.churn_text(spark, d, dirty)
    silver, _ = CL.silver_from_bronze(as_bronze(text), "2024-01-02 00:00:00", strategy)
    return silver


def gold_churn(spark, d) -> DataFrame:
    silver = silver_churn(spark, d)
    return FE.gold_features(silver)


# ---------------------------------------------------------------------------
# shared SQL building blocks
# ---------------------------------------------------------------------------

def _dirty_reject_sql() -> str:
    return "(c_custkey % 97 = 0 OR c_custkey % 89 = 0)"


SILVER_SQL = S.churn_silver_sql(False)
SILVER_DIRTY_SQL = f"SELECT * FROM ({S.churn_silver_sql(True)}) x WHERE NOT {_dirty_reject_sql()}"

def gold_body_sql(silver_sql: str) -> str:
    """Gold feature columns (no split) over a Silver relation, as the oracle computes them."""
    return f"""
SELECT c_custkey, customer_id, senior_citizen,
  CAST(partner = 'yes' AS INTEGER) AS partner, CAST(dependents = 'yes' AS INTEGER) AS dependents,
  tenure_months, CAST(phone_service = 'yes' AS INTEGER) AS phone_service,
  CAST(paperless_billing = 'yes' AS INTEGER) AS paperless_billing,
  monthly_charges, total_charges, churn,
  CASE WHEN tenure_months > 0 THEN total_charges / tenure_months ELSE monthly_charges END AS avg_charge_per_month,
  CAST(tenure_months >= {C.LONG_TENURE_MONTHS} AS INTEGER) AS is_long_tenure,
  CAST(monthly_charges >= {C.HIGH_SPENDER_MONTHLY} AS INTEGER) AS is_high_spender,
  CAST(gender = 'male' AS INTEGER) AS gender_male,
  {", ".join(f"CAST({c} = '{v}' AS INTEGER) AS {FX.one_hot_name(c, v)}"
             for c, vals in C.ONE_HOT_VOCABULARY.items() for v in vals)}
FROM ({silver_sql}) s"""


GOLD_BODY_SQL = gold_body_sql(SILVER_SQL)

def gold_sql(body_sql: str) -> str:
    """Gold rows with the split by the hash of the text id."""
    return f"""
SELECT * EXCLUDE (c_custkey, _h), {duck.split_label_sql('_h')} AS _split
FROM ({duck.spark_hash_text(body_sql, 'customer_id', '_h')}) g"""


GOLD_SQL = gold_sql(GOLD_BODY_SQL)


def _round_cols_sql(cols_double) -> str:
    return ", ".join(r(c, c) for c in cols_double)


GOLD_DOUBLES = ("monthly_charges", "total_charges", "avg_charge_per_month")


# ---------------------------------------------------------------------------
# Gold features (P6-P13, A4) -- flagship
# ---------------------------------------------------------------------------

@register("gold_features", f"SELECT * REPLACE ({_round_cols_sql(GOLD_DOUBLES)}) FROM ({GOLD_SQL}) q")
def q_gold_features(spark, d):
    return rounded(gold_churn(spark, d))


@register("split_counts", f"SELECT _split, count(*) AS n_rows FROM ({GOLD_SQL}) g GROUP BY _split")
def q_split_counts(spark, d):
    return FE.split_counts(gold_churn(spark, d))


@register("hash_split", f"""
SELECT c_custkey, abs(_h::BIGINT) % 10 AS bucket, {duck.split_label_sql('_h')} AS _split
FROM ({duck.spark_hash_long('SELECT c_custkey FROM customer', 'c_custkey', '_h')}) h""")
def q_hash_split(spark, d):
    cust = S.table(spark, d, "customer")
    return cust.select("c_custkey", FX.hash_bucket("c_custkey").alias("bucket"),
                       FX.split_label("c_custkey").alias("_split"))


@register("ratio_feature", f"""
SELECT customer_id, tenure_months, {r('total_charges', 'total_charges')},
  {r('monthly_charges', 'monthly_charges')},
  {r('CASE WHEN tenure_months > 0 THEN total_charges / tenure_months ELSE monthly_charges END',
     'avg_charge_per_month')}
FROM ({SILVER_SQL}) s""")
def q_ratio_feature(spark, d):
    s = silver_churn(spark, d)
    return rounded(s.select(
        "customer_id", "tenure_months", "total_charges", "monthly_charges",
        FX.safe_ratio("total_charges", "tenure_months", "monthly_charges").alias("avg_charge_per_month")))


@register("threshold_flags", f"""
SELECT customer_id,
  CAST(tenure_months >= {C.LONG_TENURE_MONTHS} AS INTEGER) AS is_long_tenure,
  CAST(monthly_charges >= {C.HIGH_SPENDER_MONTHLY} AS INTEGER) AS is_high_spender,
  {", ".join(f"CAST({c} = 'yes' AS INTEGER) AS {c}" for c in C.YES_NO_COLUMNS)},
  CAST(gender = 'male' AS INTEGER) AS gender_male
FROM ({SILVER_SQL}) s""")
def q_threshold_flags(spark, d):
    s = silver_churn(spark, d)
    return s.select(
        "customer_id",
        FX.at_least("tenure_months", C.LONG_TENURE_MONTHS).alias("is_long_tenure"),
        FX.at_least("monthly_charges", C.HIGH_SPENDER_MONTHLY).alias("is_high_spender"),
        *[FX.equals_flag(c, "yes").alias(c) for c in C.YES_NO_COLUMNS],
        FX.equals_flag("gender", "male").alias("gender_male"))


SEGMENTS = ("automobile", "building", "furniture", "household", "machinery")


@register("one_hot_segment", f"""
SELECT c_custkey, {", ".join(f"CAST(lower(trim(c_mktsegment)) = '{v}' AS INTEGER) AS c_mktsegment_{v}"
                            for v in SEGMENTS)}
FROM customer""")
def q_one_hot_segment(spark, d):
    cust = S.table(spark, d, "customer").select("c_custkey", F.lower(F.trim("c_mktsegment")).alias("c_mktsegment"))
    return cust.select("c_custkey", *FX.one_hot("c_mktsegment", SEGMENTS))


# ---------------------------------------------------------------------------
# Silver: casts, quarantine, dedup, upsert, gates
# ---------------------------------------------------------------------------

SILVER_COLS = ("customer_id",) + C.RAW_COLUMNS[1:]


@register("silver_cast_normalize", f"""
SELECT customer_id, gender, senior_citizen, partner, dependents, tenure_months, phone_service,
  internet_service, contract_type, paperless_billing, payment_method,
  {r('monthly_charges', 'monthly_charges')}, {r('total_charges', 'total_charges')}, churn
FROM ({SILVER_DIRTY_SQL}) s""")
def q_silver_cast_normalize(spark, d):
    bronze = as_bronze(S.churn_text(spark, d, dirty=True))
    _, clean = QA.quarantine_split(bronze)
    return rounded(CL.normalize_churn(clean).select(*SILVER_COLS))


_QUAR_SQL = f"""
SELECT CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE '   ' END AS customer_id,
  CASE WHEN c_custkey % 97 = 0 THEN 'missing_id' ELSE 'blank_id' END AS _reject_reason,
  CASE WHEN c_custkey % 7 = 0 THEN '  ' || upper(gender) ELSE gender END AS gender,
  CASE WHEN c_custkey % 83 = 0 THEN NULL ELSE round(monthly, 6) END AS monthly_value,
  churn
FROM ({S.CHURN_TYPED_SQL}) t WHERE {_dirty_reject_sql()}"""


def _quarantine_view(q: DataFrame) -> DataFrame:
    return q.select("customer_id", "_reject_reason", "gender",
                    round6(F.col("monthly_charges").try_cast("double")).alias("monthly_value"),
                    "churn")


@register("quarantine_split", _QUAR_SQL)
def q_quarantine_split(spark, d):
    quarantine, _ = QA.quarantine_split(as_bronze(S.churn_text(spark, d, dirty=True)))
    return _quarantine_view(quarantine)


@register("clean_split", f"""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id_trimmed, churn
FROM ({S.CHURN_TYPED_SQL}) t WHERE NOT {_dirty_reject_sql()}""")
def q_clean_split(spark, d):
    _, clean = QA.quarantine_split(as_bronze(S.churn_text(spark, d, dirty=True)))
    return clean.select(F.trim("customer_id").alias("customer_id_trimmed"), "churn")


@register("silver_strict", f"""
SELECT CASE WHEN {_dirty_reject_sql()} THEN 'rejected' WHEN c_custkey % 7 = 0 THEN 'unexpected_columns' ELSE 'silver' END AS outcome,
  count(*) AS n_rows, count(CASE WHEN c_custkey % 7 = 0 AND NOT {_dirty_reject_sql()} THEN 1 END) AS n_with_segment
FROM ({S.CHURN_TYPED_SQL}) t GROUP BY 1""")
def q_silver_strict(spark, d):
    """A landing column that Silver does not declare (S21): every seventh row with an id has one, and goes to the quarantine with it."""
    wide = as_bronze(S.churn_text(spark, d, dirty=True), extra={"segment": F.when(F.col("customer_id").try_cast("bigint") % 7 == 0, "retail")})
    silver, quarantine = CL.silver_from_bronze(wide, extra="quarantine")
    assert "segment" not in silver.columns
    aside = F.when(F.col("_reject_reason") == "unexpected_columns", F.col("_reject_reason")).otherwise("rejected").alias("outcome")
    both = quarantine.select(aside, "segment").unionByName(silver.select(F.lit("silver").alias("outcome"), F.lit(None).cast("string").alias("segment")))
    return both.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_rows"), F.count("segment").alias("n_with_segment"))


ORDER_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
LATEST_SQL = f"""
SELECT {", ".join(ORDER_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) t WHERE rn = 1"""


@register("latest_per_key", LATEST_SQL)
def q_latest_per_key(spark, d):
    o = S.table(spark, d, "orders")
    return CL.latest_per_key(o, "o_custkey", ["o_orderdate", "o_orderkey"])


@register("quality_gate_report", """
SELECT count(*) AS row_count,
  count(DISTINCT o_orderkey) + least(count(*) FILTER (WHERE o_orderkey IS NULL), 1) AS distinct_keys,
  count(*) FILTER (WHERE o_orderkey IS NULL) AS null_keys,
  count(*) FILTER (WHERE o_custkey IS NULL) AS nulls_o_custkey,
  count(*) FILTER (WHERE o_orderdate IS NULL) AS nulls_o_orderdate,
  count(*) FILTER (WHERE o_totalprice IS NULL) AS nulls_o_totalprice,
  CAST(count(DISTINCT o_orderkey) + least(count(*) FILTER (WHERE o_orderkey IS NULL), 1) = count(*) AS INTEGER)
    AS unique_ok,
  CAST(count(*) > 0 AS INTEGER) AS non_empty_ok,
  CAST(count(*) FILTER (WHERE o_custkey IS NULL) + count(*) FILTER (WHERE o_orderdate IS NULL)
       + count(*) FILTER (WHERE o_totalprice IS NULL) = 0 AS INTEGER) AS required_ok
FROM orders""")
def q_quality_gate_report(spark, d):
    o = S.table(spark, d, "orders")
    return QA.quality_report(o, "o_orderkey", ("o_custkey", "o_orderdate", "o_totalprice"))


# ---------------------------------------------------------------------------
# Evaluation on labelled rows
# ---------------------------------------------------------------------------

from ..operators import evaluate as EV  # noqa: E402

LABELLED_SQL = duck.spark_hash_long(f"""
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount + 0.0 AS l_discount,
  l_tax + 0.0 AS l_tax, CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) AS ship_days,
  CAST(l_returnflag = 'R' AS INTEGER) AS label
FROM lineitem""", "l_orderkey", "_h")
LABELLED_SQL = f"SELECT * EXCLUDE (_h), {duck.split_label_sql('_h')} AS _split FROM ({LABELLED_SQL}) l"
RULE_THRESHOLD = 0.05


def _rule_scored(spark, d):
    li = S.labelled_rows(spark, d)
    return li.withColumns({"score": F.col("l_discount") + F.col("l_tax"),
                           "prediction": (F.col("l_discount") >= RULE_THRESHOLD).cast("int")})


def _ratio_sql(num, den):
    return f"CASE WHEN ({den}) > 0 THEN CAST({num} AS DOUBLE) / ({den}) ELSE 0.0 END"


CONFUSION_SQL = f"""
SELECT _split, tp, fp, tn, fn, n_classes,
  {r(_ratio_sql('tp + tn', 'tp + fp + tn + fn'), 'accuracy')},
  {r(_ratio_sql('tp', 'tp + fp'), 'precision')},
  {r(_ratio_sql('tp', 'tp + fn'), 'recall')},
  {r(_ratio_sql('2 * tp', '2 * tp + fp + fn'), 'f1')}
FROM (
  SELECT _split,
    count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
    count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
    count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
    count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
    count(DISTINCT label) AS n_classes
  FROM (SELECT *, CAST(l_discount >= {RULE_THRESHOLD} AS INTEGER) AS prediction FROM ({LABELLED_SQL}) a) b
  GROUP BY _split) c"""


@register("confusion_metrics", CONFUSION_SQL)
def q_confusion_metrics(spark, d):
    return rounded(EV.confusion_metrics(_rule_scored(spark, d), "label", "prediction", ["_split"]))


AUC_SQL = f"""
WITH s AS (SELECT _split, l_discount + l_tax AS score, label FROM ({LABELLED_SQL}) a),
ranked AS (SELECT _split, label, rank() OVER (PARTITION BY _split ORDER BY score) AS lo,
                  count(*) OVER (PARTITION BY _split ORDER BY score RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi
           FROM s),
agg AS (SELECT _split, CAST(sum(label) AS BIGINT) AS n_pos, CAST(sum(1 - label) AS BIGINT) AS n_neg,
               sum(CASE WHEN label = 1 THEN (lo + hi) / 2.0 ELSE 0 END) AS pos_rank_sum
        FROM ranked GROUP BY _split)
SELECT _split, n_pos, n_neg,
  {r('CASE WHEN n_pos > 0 AND n_neg > 0 THEN (pos_rank_sum - n_pos * (n_pos + 1) / 2.0) / (n_pos * n_neg) ELSE 0.0 END', 'auc')}
FROM agg"""


@register("auc_rank", AUC_SQL)
def q_auc_rank(spark, d):
    return rounded(EV.roc_auc(_rule_scored(spark, d), "label", "score", ["_split"]))


@register("scaler_stats", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT {i} AS position, '{f}' AS feature, {r(f'avg({f})', 'mean')}, {r(f'stddev_pop({f})', 'std')} "
    f"FROM ({LABELLED_SQL}) a WHERE _split = 'train'" for i, f in enumerate(S.LABEL_FEATURES)) + ") u")
def q_scaler_stats(spark, d):
    li = S.labelled_rows(spark, d).filter(F.col("_split") == "train")
    return rounded(EV.scaler_stats(li, list(S.LABEL_FEATURES)))


@register("scaled_features", f"""
WITH st AS (SELECT {", ".join(f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in S.LABEL_FEATURES)}
            FROM ({LABELLED_SQL}) a WHERE _split = 'train')
SELECT l_orderkey, l_linenumber,
  {", ".join(r(f"({f} - m_{f}) / CASE WHEN s_{f} IS NULL OR s_{f} = 0 THEN 1 ELSE s_{f} END", f)
             for f in S.LABEL_FEATURES)}
FROM ({LABELLED_SQL}) a, st""")
def q_scaled_features(spark, d):
    li = S.labelled_rows(spark, d)
    stats = EV.scaler_stats(li.filter(F.col("_split") == "train"), list(S.LABEL_FEATURES))
    return rounded(EV.standardize(li, stats, list(S.LABEL_FEATURES), keep=("l_orderkey", "l_linenumber")))


# ---------------------------------------------------------------------------
# Operational rollups over the request log
# ---------------------------------------------------------------------------

from ..operators import ops as OP  # noqa: E402

LOG_SQL = S.REQUEST_LOG_SQL
SLIDE_SQL = f"""
SELECT l.*, time_bucket(INTERVAL '1 minute', ts) - to_minutes(t.k) AS window_start,
       time_bucket(INTERVAL '1 minute', ts) - to_minutes(t.k) + INTERVAL '5 minutes' AS window_end
FROM ({LOG_SQL}) l CROSS JOIN (SELECT range AS k FROM range(5)) t"""
TRAILING_DAY_SQL = f"""
SELECT l.*, time_bucket(INTERVAL '1 hour', ts) - to_hours(t.k) AS window_start,
       time_bucket(INTERVAL '1 hour', ts) - to_hours(t.k) + INTERVAL '24 hours' AS window_end
FROM ({LOG_SQL}) l CROSS JOIN (SELECT range AS k FROM range(24)) t"""


@register("requests_per_second", f"""
SELECT window_start, window_end, count(*) AS requests, {r('count(*) / 300.0', 'per_second')}
FROM ({SLIDE_SQL}) w GROUP BY window_start, window_end""")
def q_requests_per_second(spark, d):
    return rounded(OP.request_rate(S.request_log(spark, d)))


@register("rps_by_status", f"""
SELECT window_start, window_end, status_code, count(*) AS requests, {r('count(*) / 300.0', 'per_second')}
FROM ({SLIDE_SQL}) w GROUP BY window_start, window_end, status_code""")
def q_rps_by_status(spark, d):
    return rounded(OP.request_rate(S.request_log(spark, d), by=("status_code",)))


@register("request_counters", f"""
SELECT http_method, http_path, status_code, count(*) AS requests
FROM ({LOG_SQL}) l GROUP BY ALL""")
def q_request_counters(spark, d):
    return OP.request_counters(S.request_log(spark, d))


ERR_RATIO_SQL = f"""
SELECT window_start, window_end, count(*) AS requests,
  count(*) FILTER (WHERE regexp_full_match(CAST(status_code AS VARCHAR), '5..')) AS errors
FROM ({SLIDE_SQL}) w GROUP BY window_start, window_end"""


@register("error_ratio", f"""
SELECT window_start, window_end, requests, errors, {r('errors / requests', 'error_ratio')},
  CASE WHEN errors / requests >= {C.ERROR_RATIO_RED} THEN 'red'
       WHEN errors / requests >= {C.ERROR_RATIO_YELLOW} THEN 'yellow' ELSE 'green' END AS band
FROM ({ERR_RATIO_SQL}) e""")
def q_error_ratio(spark, d):
    return rounded(OP.error_ratio(S.request_log(spark, d)))


@register("error_budget", f"""
SELECT window_start, window_end, count(*) AS requests,
  count(*) FILTER (WHERE NOT regexp_full_match(CAST(status_code AS VARCHAR), '5..')) AS ok_requests,
  {r("1 - count(*) FILTER (WHERE NOT regexp_full_match(CAST(status_code AS VARCHAR), '5..')) / count(*)",
     'budget_consumed')}
FROM ({TRAILING_DAY_SQL}) w GROUP BY window_start, window_end""")
def q_error_budget(spark, d):
    return rounded(OP.error_budget(S.request_log(spark, d)))


@register("predictions_per_minute", f"""
SELECT window_start, window_end, count(*) AS requests, {r('count(*) / 5.0', 'per_minute')}
FROM ({SLIDE_SQL}) w WHERE predicted_class IS NOT NULL GROUP BY window_start, window_end""")
def q_predictions_per_minute(spark, d):
    return rounded(OP.request_rate(OP.predictions(S.request_log(spark, d)), per="minute"))


@register("class_distribution", f"""
SELECT window_start, window_end, predicted_class, count(*) AS predictions,
  {r('count(*) / sum(count(*)) OVER (PARTITION BY window_start, window_end)', 'share')}
FROM ({SLIDE_SQL}) w WHERE predicted_class IS NOT NULL GROUP BY window_start, window_end, predicted_class""")
def q_class_distribution(spark, d):
    return rounded(OP.class_distribution(S.request_log(spark, d)))


def _bucket_sql(value: str, bounds) -> str:
    return ", ".join(f"count(*) FILTER (WHERE {value} <= {float(b)!r}::DOUBLE) AS _le{i}" for i, b in enumerate(bounds))


def _quantile_sql(q: float, bounds, alias: str) -> str:
    cums = "[" + ", ".join(f"_le{i}" for i in range(len(bounds))) + "]"
    les = "[" + ", ".join(f"{float(b)!r}::DOUBLE" for b in bounds) + "]"
    n = len(bounds)
    rank = f"({float(q)!r}::DOUBLE * _count)"
    idx = f"len(list_filter({cums}, lambda c: c < {rank}))"
    start = f"(CASE WHEN {idx} = 0 THEN 0.0 ELSE {les}[greatest({idx}, 1)] END)"
    prev = f"(CASE WHEN {idx} = 0 THEN 0 ELSE {cums}[greatest({idx}, 1)] END)"
    end = f"{les}[least({idx} + 1, {n})]"
    cur = f"{cums}[least({idx} + 1, {n})]"
    expr = (f"CASE WHEN _count = 0 THEN 'NaN'::DOUBLE WHEN {idx} >= {n} THEN {float(bounds[-1])!r}::DOUBLE "
            f"ELSE {start} + ({end} - {start}) * ({rank} - {prev}) / ({cur} - {prev}) END")
    return r(expr, alias)


def _latency_quantiles_sql(src: str, keys: str, value: str, bounds, qs) -> str:
    return f"""
SELECT {keys}, _count AS observations, {", ".join(_quantile_sql(q, bounds, f"p{int(round(q * 100))}") for q in qs)}
FROM (SELECT {keys}, {_bucket_sql(value, bounds)}, count({value}) AS _count FROM ({src}) s GROUP BY {keys}) a"""


@register("latency_histogram", f"""
SELECT http_method, http_path, {r('sum_seconds', 'sum_seconds')}, count, le, cumulative_count FROM (
  SELECT http_method, http_path, sum(duration_s) AS sum_seconds, count(duration_s) AS count,
    {_bucket_sql('duration_s', C.LATENCY_BUCKETS)}
  FROM ({LOG_SQL}) l GROUP BY ALL) a,
  LATERAL (SELECT unnest([{", ".join(repr(x) for x in OP.le_labels(C.LATENCY_BUCKETS))}]) AS le,
                  unnest([{", ".join(f"_le{i}" for i in range(len(C.LATENCY_BUCKETS)))}, count]) AS cumulative_count) u""")
def q_latency_histogram(spark, d):
    return rounded(OP.latency_histogram(S.request_log(spark, d)))


@register("latency_quantiles", _latency_quantiles_sql(SLIDE_SQL, "window_start, window_end", "duration_s",
                                                      C.LATENCY_BUCKETS, (0.5, 0.95, 0.99)))
def q_latency_quantiles(spark, d):
    return rounded(OP.latency_quantiles(S.request_log(spark, d)))


@register("inference_quantiles", _latency_quantiles_sql(SLIDE_SQL, "window_start, window_end", "inference_s",
                                                        C.DEFAULT_BUCKETS, (0.5, 0.95)))
def q_inference_quantiles(spark, d):
    return rounded(OP.latency_quantiles(S.request_log(spark, d), "inference_s", (0.5, 0.95), C.DEFAULT_BUCKETS))


@register("slowest_endpoints", f"""
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY window_start, window_end ORDER BY p99 DESC, http_path) AS INTEGER)
    AS rank
  FROM ({_latency_quantiles_sql(SLIDE_SQL, "window_start, window_end, http_path", "duration_s",
                                C.LATENCY_BUCKETS, (0.99,))}) q) t WHERE rank <= 5""")
def q_slowest_endpoints(spark, d):
    return rounded(OP.slowest_endpoints(S.request_log(spark, d)))


ALERT_SQL = f"""
SELECT 'HighErrorRate' AS alertname, 'churn' AS namespace, 'page' AS severity, fires_at FROM (
  SELECT window_end + to_minutes(t.k) AS fires_at, count(*) AS votes
  FROM ({ERR_RATIO_SQL}) e CROSS JOIN (SELECT range AS k FROM range(6)) t
  WHERE errors / requests > {C.ERROR_RATIO_RED}
  GROUP BY 1) v WHERE votes = 6"""


@register("error_alert", ALERT_SQL)
def q_error_alert(spark, d):
    return OP.error_alert(S.request_log(spark, d))


@register("alert_groups", f"""
SELECT alertname, namespace, time_bucket(INTERVAL '1 day', fires_at) AS window_start,
  count(*) AS firing_instants, min(fires_at) AS first_firing, max(fires_at) AS last_firing
FROM ({ALERT_SQL}) a GROUP BY ALL""")
def q_alert_groups(spark, d):
    return OP.alert_groups(OP.error_alert(S.request_log(spark, d)))


def log_lines(spark, d):
    """The service's log of ``events``: a line per request (finished or failed) and one per
    prediction returned; every 101st request line and 103rd prediction line is truncated."""
    log = S.request_log(spark, d)
    seq, failed = F.col("request_seq"), OP.is_5xx()
    bound = [F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
             F.when(failed, "error").otherwise("info").alias("level"),
             F.concat(F.lit("req_"), F.substring(F.sha2(seq.cast("string"), 256), 1, 12)).alias("request_id"),
             F.col("http_method"), F.col("http_path")]
    request = F.to_json(F.struct(
        *bound, F.when(failed, "request_failed").otherwise("request_finished").alias("event"),
        F.when(~failed, F.col("status_code")).alias("status_code"),
        F.round(F.col("duration_s") * 1000, 2).alias("duration_ms")))
    prediction = F.to_json(F.struct(
        *bound, F.lit("prediction_returned").alias("event"), "predicted_class",
        (F.lit(0.15) + 0.7 * F.col("predicted_class")).alias("probability")))
    lines = F.filter(F.array(
        F.struct(F.lit("request").alias("kind"),
                 F.when(seq % 101 == 0, F.substring(request, 1, 40)).otherwise(request).alias("value")),
        F.struct(F.lit("prediction").alias("kind"),
                 F.when(F.col("predicted_class").isNotNull(),
                        F.when(seq % 103 == 0, F.substring(prediction, 1, 40)).otherwise(prediction)).alias("value"))),
        lambda x: x["value"].isNotNull())
    return log.select("request_seq", F.inline(lines))


_RID_SQL = "'req_' || substr(sha256(CAST(request_seq AS VARCHAR)), 1, 12)"
_IS_FAILED_SQL = "regexp_full_match(CAST(status_code AS VARCHAR), '5..')"


def _unless(bad: str, **cols: str) -> str:
    return ", ".join(f"CASE WHEN {bad} THEN NULL ELSE {e} END AS {c}" for c, e in cols.items())


@register("log_parse", f"""
SELECT request_seq, 'request' AS kind, {_unless("request_seq % 101 = 0",
  event=f"CASE WHEN {_IS_FAILED_SQL} THEN 'request_failed' ELSE 'request_finished' END",
  request_id=_RID_SQL, http_path="http_path", status_code=f"CASE WHEN NOT {_IS_FAILED_SQL} THEN status_code END",
  duration_ms="round(duration_s * 1000, 2)", predicted_class="NULL::INTEGER", probability="NULL::DOUBLE", ts="ts")},
  CAST(request_seq % 101 = 0 AS INTEGER) AS malformed
FROM ({LOG_SQL}) l
UNION ALL
SELECT request_seq, 'prediction', {_unless("request_seq % 103 = 0",
  event="'prediction_returned'", request_id=_RID_SQL, http_path="http_path", status_code="NULL",
  duration_ms="NULL", predicted_class="predicted_class", probability="round(0.15::DOUBLE + 0.7::DOUBLE * predicted_class, 6)", ts="ts")},
  CAST(request_seq % 103 = 0 AS INTEGER)
FROM ({LOG_SQL}) l WHERE predicted_class IS NOT NULL""")
def q_log_parse(spark, d):
    parsed = OP.parse_log(log_lines(spark, d), keep=("request_seq", "kind"))
    return parsed.select("request_seq", "kind", "event", "request_id", "http_path", "status_code", "duration_ms",
                         "predicted_class", round6("probability").alias("probability"), "ts",
                         F.col("_bad_line").isNotNull().cast("int").alias("malformed"))


LOG_PREDICTIONS_SQL = f"""
SELECT {_RID_SQL} AS request_id, http_path, status_code, round(duration_s * 1000, 2) AS duration_ms, ts,
  CASE WHEN request_seq % 103 <> 0 THEN predicted_class END AS predicted_class,
  CASE WHEN request_seq % 103 <> 0 THEN round(0.15::DOUBLE + 0.7::DOUBLE * predicted_class, 6) END AS probability
FROM ({LOG_SQL}) l WHERE request_seq % 101 <> 0"""


@register("log_predictions", LOG_PREDICTIONS_SQL)
def q_log_predictions(spark, d):
    joined = OP.request_predictions(OP.parse_log(log_lines(spark, d)))
    return joined.select("request_id", "http_path", "status_code", "duration_ms", "ts", "predicted_class",
                         round6("probability").alias("probability"))
