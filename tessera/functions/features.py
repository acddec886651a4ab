"""Feature expressions of the Gold layer.

All are plain Column expressions, so a whole feature set compiles into one
projection inside whole-stage codegen -- no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPLIT_BUCKETS = 10


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def flag(cond: Column) -> Column:
    """Predicate to 0/1 int; NULL input stays NULL."""
    return cond.cast("int")


def at_least(col, threshold) -> Column:
    """``(col >= threshold)`` as int, e.g. long tenure, high spender."""
    return flag(_c(col) >= F.lit(threshold))


def equals_flag(col, value: str) -> Column:
    """``(col == value)`` as int, e.g. yes/no encoding and ``gender_male``."""
    return flag(_c(col) == F.lit(value))


def one_hot_name(col_name: str, value: str) -> str:
    """Flag column name: ``col_`` + value with spaces and dashes as underscores."""
    return f"{col_name}_{value.replace(' ', '_').replace('-', '_')}"


def one_hot(col_name: str, values) -> list[Column]:
    """Fixed-vocabulary one-hot flags (P9): unseen value -> all 0, NULL -> all NULL."""
    return [equals_flag(col_name, v).alias(one_hot_name(col_name, v)) for v in values]


def safe_ratio(total, tenure, fallback) -> Column:
    """``tenure > 0 ? total / tenure : fallback``; NULL tenure takes the fallback (P10)."""
    t = _c(tenure)
    return F.when(t > 0, _c(total) / t).otherwise(_c(fallback))


def hash_bucket(key, buckets: int = SPLIT_BUCKETS) -> Column:
    """``abs(hash(key)) % buckets`` via bigint, so ``hash = -2^31`` cannot overflow."""
    return F.abs(F.hash(_c(key)).cast("bigint")) % F.lit(buckets)


def split_label(key, train_below: int = 8, val_bucket: int = 8,
                buckets: int = SPLIT_BUCKETS) -> Column:
    """Deterministic train/val/test label from the key's hash bucket."""
    b = hash_bucket(key, buckets)
    return (F.when(b < train_below, F.lit("train"))
             .when(b == val_bucket, F.lit("val"))
             .otherwise(F.lit("test")))
