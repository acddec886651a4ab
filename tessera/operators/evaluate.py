"""Model evaluation as aggregations.

* ``confusion_metrics`` -- one pass, ``count_if`` per cell, zero-division -> 0.
* ``roc_auc`` -- exact, tie-averaged ROC-AUC with the single-class guard.
  It needs, for each distinct score, the number of negatives scored lower:
  a prefix sum in score order.  A window ordered over the whole group would
  put the group in one task, so scores are split into range buckets
  (approximate quantiles of the distinct scores, one small array per group);
  the prefix runs inside each bucket, and the wins against lower buckets
  come from bucket totals alone (sum of P_b x N_<b over a few rows), so the
  data is never joined back to itself.  Exact; buckets only spread the work.
* ``binary_metrics`` -- confusion counts at a threshold and the AUC from the
  same per-score aggregate: one pass over the data for both.
* ``scaler_stats`` / ``standardize`` -- mean and population std fitted on
  one split and applied as literals (the statistics are 2 numbers per
  feature, whatever the data size).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def confusion_metrics(df: DataFrame, label: str, prediction: str, group_cols=()) -> DataFrame:
    """Accuracy, precision, recall, F1 (zero-division -> 0) and class count."""
    y, p = F.col(label), F.col(prediction)
    agg = (df.groupBy(*group_cols) if group_cols else df.groupBy()).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        # the label set is tiny: a set aggregate avoids the distinct-aggregation rewrite
        F.size(F.collect_set(y)).cast("long").alias("n_classes"),
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    precision = _ratio(tp.cast("double"), tp + fp)
    recall = _ratio(tp.cast("double"), tp + fn)
    return agg.withColumns({
        "accuracy": _ratio((tp + tn).cast("double"), tp + fp + tn + fn),
        "precision": precision,
        "recall": recall,
        "f1": _ratio(2 * tp.cast("double"), 2 * tp + fp + fn),
    })


def _per_score(df: DataFrame, label: str, score: str, g: list, weight: str | None = None) -> DataFrame:
    """One row per (group, distinct score): positives and negatives at that score
    (a row stands for ``weight`` equal ones)."""
    y = F.col(label).cast("long")
    w = F.col(weight).cast("long") if weight else F.lit(1)
    return df.groupBy(*g, F.col(score).alias("_s")).agg(F.sum(y * w).alias("_pos"), F.sum((1 - y) * w).alias("_neg"))


def _bucket_totals(per_score: DataFrame, g: list, buckets: int, accuracy: int, extra=None) -> DataFrame:
    """Per (group, score bucket): P, N and the within-bucket pairs won ``W``,
    plus any ``extra`` additive per-score aggregates.

    Bucket bounds are approximate quantiles of the distinct scores.  The
    bounds aggregate also totals P and N, so it reads every column of the
    per-score aggregate and Spark reuses that exchange instead of computing
    it twice.
    """
    probs = [i / buckets for i in range(1, buckets)]
    stats = per_score.groupBy(*g).agg(F.percentile_approx("_s", probs, accuracy).alias("_bounds"),
                                      F.sum("_pos").alias("_p_tot"), F.sum("_neg").alias("_n_tot"))
    # groups x buckets values: AQE broadcasts it when its measured size allows
    bucketed = per_score.join(stats, g, "inner").withColumn(
        "_b", F.size(F.filter(F.col("_bounds"), lambda b: b < F.col("_s"))))
    ws = Window.partitionBy(*g, "_b").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    within = bucketed.withColumn("_nb", F.coalesce(F.sum("_neg").over(ws), F.lit(0)))
    aggs = [F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"),
            F.sum(F.col("_pos").cast("double") * (F.col("_nb") + F.col("_neg") * 0.5)).alias("_W"),
            F.first("_p_tot").alias("n_pos"), F.first("_n_tot").alias("n_neg")]
    aggs += [c.alias(n) for n, c in (extra or {}).items()]
    return within.groupBy(*g, "_b").agg(*aggs)


def score_buckets(df: DataFrame) -> int:
    """Score ranges a group is cut into: as many tasks as a shuffle has, 64 at least."""
    return max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _won_pairs(per_bucket: DataFrame, g: list, extra=()) -> DataFrame:
    """Pairs won per group: within-bucket wins plus P_b x negatives of all lower buckets
    (a prefix over at most ``buckets`` rows per group)."""
    wb = Window.partitionBy(*g).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    pb = per_bucket.withColumn("_n_lower", F.coalesce(F.sum("_N").over(wb), F.lit(0)))
    return pb.groupBy(*g).agg(
        F.sum(F.col("_W") + F.col("_P").cast("double") * F.col("_n_lower")).alias("_won"),
        F.first("n_pos").alias("n_pos"), F.first("n_neg").alias("n_neg"),
        *[F.sum(c).alias(c) for c in extra])


def _auc(won: DataFrame) -> Column:
    return F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                  F.col("_won") / (F.col("n_pos").cast("double") * F.col("n_neg"))).otherwise(F.lit(0.0))


def roc_auc(df: DataFrame, label: str, score: str, group_cols=(), buckets: int | None = None,
            accuracy: int = 10000) -> DataFrame:
    """Exact tie-averaged ROC-AUC per group; 0.0 when a group has one class."""
    g = list(group_cols) or ["_g"]
    src = df if group_cols else df.withColumn("_g", F.lit(0))
    buckets = buckets or score_buckets(df)
    won = _won_pairs(_bucket_totals(_per_score(src, label, score, g), g, buckets, accuracy), g)
    return won.select(*group_cols, "n_pos", "n_neg", _auc(won).alias("auc"))


def binary_metrics(df: DataFrame, label: str, score: str, threshold, group_cols=(), strict: bool = False,
                   buckets: int | None = None, accuracy: int = 10000, weight: str | None = None) -> DataFrame:
    """Confusion metrics of ``score >= threshold`` (``>`` when ``strict``) and the
    exact ROC-AUC of ``score``, from one per-score aggregate -- one pass over
    the data for both (A5, A6, A8, M7).  ``threshold`` is a number or a column
    constant within each group; ``weight`` is a column of row counts."""
    g = list(group_cols) or ["_g"]
    src = df if group_cols else df.withColumn("_g", F.lit(0))
    t = F.col(threshold) if isinstance(threshold, str) else F.lit(float(threshold))
    if isinstance(threshold, str) and threshold not in g:
        g = g + [threshold]
    hit = (F.col("_s") > t) if strict else (F.col("_s") >= t)
    extra = {"tp": F.sum(F.when(hit, F.col("_pos")).otherwise(0)),
             "fp": F.sum(F.when(hit, F.col("_neg")).otherwise(0)),
             "fn": F.sum(F.when(~hit, F.col("_pos")).otherwise(0)),
             "tn": F.sum(F.when(~hit, F.col("_neg")).otherwise(0))}
    buckets = buckets or score_buckets(df)
    won = _won_pairs(_bucket_totals(_per_score(src, label, score, g, weight), g, buckets, accuracy, extra), g,
                     extra=tuple(extra))
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    keep = [c for c in g if c != "_g"]
    return won.select(
        *keep, "tp", "fp", "tn", "fn",
        ((F.col("n_pos") > 0).cast("long") + (F.col("n_neg") > 0).cast("long")).alias("n_classes"),
        _ratio((tp + tn).cast("double"), tp + fp + tn + fn).alias("accuracy"),
        _ratio(tp.cast("double"), tp + fp).alias("precision"),
        _ratio(tp.cast("double"), tp + fn).alias("recall"),
        _ratio(2 * tp.cast("double"), 2 * tp + fp + fn).alias("f1"),
        "n_pos", "n_neg", _auc(won).alias("auc"))


def scaler_stats(df: DataFrame, features) -> DataFrame:
    """Long table (feature, mean, std) with population std, one aggregation."""
    aggs = []
    for f in features:
        aggs += [F.avg(f).alias(f"m_{f}"), F.stddev_pop(f).alias(f"s_{f}")]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f).alias("feature"),
                              F.col(f"m_{f}").alias("mean"), F.col(f"s_{f}").alias("std"))
                     for i, f in enumerate(features)])
    return wide.select(F.inline(rows))


def standardize(df: DataFrame, stats: DataFrame, features, keep=()) -> DataFrame:
    """z-score ``features`` with fitted statistics; zero std scales by 1 (M2)."""
    st = {r.feature: (r.mean, r.std) for r in stats.collect()}  # 2 numbers per feature
    cols = [F.col(k) for k in keep]
    for f in features:
        mean, std = st[f]
        scale = std if std not in (None, 0.0) else 1.0
        cols.append(((F.col(f) - F.lit(mean)) / F.lit(scale)).alias(f))
    return df.select(*cols)
