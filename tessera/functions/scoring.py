"""Scoring expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def rule_prediction(m2m: str = "contract_type_month_to_month", tenure: str = "tenure_months") -> Column:
    """Struct(prediction, probability) of the rule predictor (C1): month-to-month
    and tenure < 12 -> (1, 0.85), else (0, 0.15); a missing flag counts as 0 and
    a missing tenure as 99."""
    hit = (F.coalesce(F.col(m2m), F.lit(0)) != 0) & \
          (F.coalesce(F.col(tenure), F.lit(C.RULE_MISSING_TENURE)) < C.RULE_SHORT_TENURE)
    pos, neg = C.RULE_POSITIVE, C.RULE_NEGATIVE
    return F.struct(
        F.when(hit, F.lit(pos[0])).otherwise(F.lit(neg[0])).alias("prediction"),
        F.when(hit, F.lit(pos[1])).otherwise(F.lit(neg[1])).alias("probability"))


def interpret_score(value: Column, threshold: float = 0.5) -> Column:
    """Struct(prediction, probability) from a model output (C2): a value strictly
    inside (0, 1) is a probability (class = value >= threshold); anything else is
    a class label with probability 0.0 / 1.0.  Numeric test, so float32 outputs
    are handled too (X13)."""
    v = value.cast("double")
    is_prob = (v > 0.0) & (v < 1.0)
    cls = F.when(is_prob, (v >= F.lit(threshold)).cast("int")).otherwise(v.cast("int"))
    prob = F.when(is_prob, v).otherwise(v.cast("int").cast("double"))
    return F.struct(cls.alias("prediction"), prob.alias("probability"))


def request_id(key: Column | None = None) -> Column:
    """Correlation id ``req_`` + 12 hex chars (F15): derived from the row key, so a
    replayed job reproduces it; without a key a random ``uuid()`` as the service did."""
    if key is None:
        return F.concat(F.lit("req_"), F.substring(F.regexp_replace(F.expr("uuid()"), "-", ""), 1, 12))
    return F.concat(F.lit("req_"), F.substring(F.sha2(key.cast("string"), 256), 1, 12))


def envelope(pred: Column, model_version: str, model_name: str, rid: Column) -> list[Column]:
    """Prediction envelope columns (C3): probability rounded half-up to 4 decimals."""
    return [pred["prediction"].alias("prediction"),
            F.round(pred["probability"], 4).alias("probability"),
            F.lit(str(model_version)).alias("model_version"),
            F.lit(model_name).alias("model_name"),
            rid.alias("request_id")]
