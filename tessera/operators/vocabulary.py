"""A vocabulary learned from the training rows (P9): which values of a text column get a one-hot column.

The declared vocabulary of the Gold job (``config.ONE_HOT_VOCABULARY``) stays what it is; this one is for columns whose values are not
known beforehand.  It is fitted by Spark, bounded by ``most`` values a column, ordered by falling frequency and then by
value, and stored with the model, so that a later batch is encoded alike.  A value outside it sets the column's
``unseen`` flag instead of vanishing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.casts import norm_text

_SCHEMA = "column_name string, position int, value string, rows bigint"


def fit_vocabulary(train: DataFrame, columns, most: int = 100) -> DataFrame:
    """column_name, position (from 1), value, rows: the ``most`` commonest normalised values of each column; nulls are no values."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), norm_text(c).alias("value")) for c in columns])
    counted = (train.select(F.explode(pairs).alias("p")).select("p.*").filter("value IS NOT NULL")
               .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("rows")))
    order = Window.partitionBy("column_name").orderBy(F.desc("rows"), "value")
    return (counted.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= most)
            .select("column_name", "position", "value", "rows"))


def save_vocabulary(vocabulary: DataFrame, model_path: str) -> None:
    vocabulary.coalesce(1).write.mode("overwrite").parquet(f"{model_path.rstrip('/')}/vocabulary")


def load_vocabulary(spark: SparkSession, model_path: str) -> dict[str, list[str]]:
    """Column to values in order (at most ``most`` of each)."""
    out: dict[str, list[str]] = {}
    for r in spark.read.schema(_SCHEMA).parquet(f"{model_path.rstrip('/')}/vocabulary").orderBy("column_name", "position").collect():
        out.setdefault(r.column_name, []).append(r.value)
    return out


def encoded(vocabulary: dict[str, list[str]]) -> list[Column]:
    """Flags ``<column>_<position>`` and ``<column>_unseen`` (0 for a null, which is no value)."""
    out = []
    for column, values in vocabulary.items():
        value = norm_text(column)
        out += [F.coalesce((value == v).cast("int"), F.lit(0)).alias(f"{column}_{i + 1}") for i, v in enumerate(values)]
        out.append(F.coalesce((~value.isin(values)).cast("int"), F.lit(0)).alias(f"{column}_unseen"))
    return out
