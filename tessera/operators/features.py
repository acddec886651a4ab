"""Gold feature table (P6-P13, A4): one projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import features as FX

META_COLUMNS = ("_ingest_ts", "_source_file")


def gold_columns(long_tenure=C.LONG_TENURE_MONTHS, high_spender=C.HIGH_SPENDER_MONTHLY,
                 one_hot: dict | None = None, split_key=None) -> list:
    """The 25 Gold columns, in the order the Gold job writes them."""
    vocab = C.ONE_HOT_VOCABULARY if one_hot is None else one_hot
    cols = [
        F.col(C.ID_COLUMN),
        F.col("senior_citizen"),
        *[FX.equals_flag(c, "yes").alias(c) for c in ("partner", "dependents")],
        F.col("tenure_months"),
        FX.equals_flag("phone_service", "yes").alias("phone_service"),
        FX.equals_flag("paperless_billing", "yes").alias("paperless_billing"),
        F.col("monthly_charges"),
        F.col("total_charges"),
        F.col(C.LABEL_COLUMN),
        FX.safe_ratio("total_charges", "tenure_months", "monthly_charges").alias("avg_charge_per_month"),
        FX.at_least("tenure_months", long_tenure).alias("is_long_tenure"),
        FX.at_least("monthly_charges", high_spender).alias("is_high_spender"),
        FX.equals_flag("gender", "male").alias("gender_male"),
    ]
    for name, values in vocab.items():
        cols += FX.one_hot(name, values)
    key = F.col(C.ID_COLUMN) if split_key is None else split_key
    cols.append(FX.split_label(key, C.SPLIT_TRAIN_BELOW, C.SPLIT_VAL_BUCKET).alias("_split"))
    return cols


def gold_features(silver: DataFrame, **kw) -> DataFrame:
    """Silver -> Gold: ratio, flags, yes/no, one-hot, hash split (the whole Gold job)."""
    return silver.select(*gold_columns(**kw))


def feature_columns(gold: DataFrame, exclude=(C.ID_COLUMN, C.LABEL_COLUMN, "_split")) -> list[str]:
    """Training features by exclusion, restricted to numeric columns."""
    numeric = ("int", "bigint", "double", "float", "smallint", "tinyint")
    return [f.name for f in gold.schema.fields
            if f.name not in exclude and f.dataType.simpleString() in numeric]


def split_counts(gold: DataFrame, split_col: str = "_split") -> DataFrame:
    """Rows per split (A4)."""
    return gold.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"))


def form_to_features(form: DataFrame, keep=(), long_tenure=C.LONG_TENURE_MONTHS,
                     high_spender=C.HIGH_SPENDER_MONTHLY) -> DataFrame:
    """User-level form values -> the 22 scoring-contract fields.

    The form carries numbers, 0/1 flags and the three categorical texts;
    the derived fields reuse the Gold expressions (one code path for
    training and serving, so no 2-decimal rounding of the ratio, X9).
    """
    cols = [F.col(k) for k in keep] + [
        F.col("tenure_months").cast("int").alias("tenure_months"),
        F.col("monthly_charges").cast("double").alias("monthly_charges"),
        F.col("total_charges").cast("double").alias("total_charges"),
        FX.safe_ratio("total_charges", "tenure_months", "monthly_charges").cast("double").alias("avg_charge_per_month"),
        *[F.col(c).cast("int").alias(c) for c in ("senior_citizen", "partner", "dependents", "phone_service",
                                                  "paperless_billing", "gender_male")],
        FX.at_least("tenure_months", long_tenure).alias("is_long_tenure"),
        FX.at_least("monthly_charges", high_spender).alias("is_high_spender"),
    ]
    for name, values in C.ONE_HOT_VOCABULARY.items():
        cols += FX.one_hot(name, values)
    return form.select(*cols)
