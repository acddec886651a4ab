"""Rollups that are stored once and answer many windows.

* ``trailing_sums``: additive aggregates over a long trailing window at a short step, from prefix sums.  The raw rows are
  counted once per step; running totals are taken per range of time, and carried over from range to range by the ranges'
  totals alone.  A window is then the difference of two prefix sums, found by an equi-join, whatever its length: 24 hours
  every 30 seconds cost two rows an instant and not 2,880.
* ``step_sketches``: per step a KLL sketch of a value and a HyperLogLog sketch of a key.  Any span of steps is answered by
  merging them (``span_quantiles``, ``span_distinct``), without another scan of the log; a stream appends closed steps to
  the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ops import _seconds


def trailing_sums(log: DataFrame, sums: dict, by=(), duration: str = "24 hours", step: str = "30 seconds", ts: str = "ts",
                  range_steps: int = 2880) -> DataFrame:
    """``by``, window_start, window_end and the ``sums`` of the trailing ``duration`` at every step from the first to the last one
    with traffic, for each label set; steps without traffic in the window are left out."""
    if _seconds(duration) % _seconds(step):
        raise ValueError("duration must be a multiple of step")
    by, step_s, n = list(by), _seconds(step), _seconds(duration) // _seconds(step)
    # step k holds [k * step, (k + 1) * step) of the epoch
    number = F.expr(f"(unix_micros(cast({ts} as timestamp)) - pmod(unix_micros(cast({ts} as timestamp)), {step_s * 1_000_000}L)) div {step_s * 1_000_000}L")
    steps = log.groupBy(number.alias("k"), *by).agg(*[c.alias(name) for name, c in sums.items()])
    first, last = steps.agg(F.min("k"), F.max("k")).first()
    if first is None:
        first, last = 0, -1
    every = F.explode(F.sequence(F.lit(first).cast("long"), F.lit(last).cast("long"))) if first <= last else F.explode(F.array().cast("array<bigint>"))
    labels = steps.select(*by).distinct() if by else steps.sparkSession.range(1).select()
    grid = labels.select(*by, every.alias("k"))
    dense = grid.join(steps, ["k", *by], "left").select("k", *by, *[F.coalesce(F.col(s), F.lit(0)).alias(s) for s in sums])
    dense = dense.withColumn("r", F.expr(f"k div {range_steps}"))
    inside = Window.partitionBy("r", *by).orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    # one row a range and label set
    before = Window.partitionBy(*by).orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    totals = dense.groupBy("r", *by).agg(*[F.sum(s).alias(s) for s in sums])
    carried = totals.select("r", *by, *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"{s}__before") for s in sums])
    prefix = dense.select("k", "r", *by, *[F.sum(s).over(inside).alias(s) for s in sums]).join(carried, ["r", *by])
    prefix = prefix.select("k", *by, *[(F.col(s) + F.col(f"{s}__before")).alias(s) for s in sums])
    old = prefix.select((F.col("k") + n).alias("k"), *by, *[F.col(s).alias(f"{s}__old") for s in sums])
    window = prefix.join(old, ["k", *by], "left").select("k", *by, *[(F.col(s) - F.coalesce(F.col(f"{s}__old"), F.lit(0))).alias(s) for s in sums])
    some = F.lit(False)
    for s in sums:
        some = some | (F.col(s) != 0)
    instant = lambda k: F.timestamp_micros(k * F.lit(step_s * 1_000_000).cast("long")).cast("timestamp_ntz")
    return window.filter(some).select(instant(F.col("k") + 1 - n).alias("window_start"), instant(F.col("k") + 1).alias("window_end"), *by, *sums)


# -- sketches --------------------------------------------------------------------

def step_sketches(log: DataFrame, value: str, key: str, by=(), step: str = "1 minute", ts: str = "ts", k: int = 200, lg_k: int = 12) -> DataFrame:
    """step_start, ``by``, observations, quantiles (KLL sketch of ``value``), keys (HyperLogLog sketch of ``key``)."""
    return (log.groupBy(F.window(ts, step).alias("w"), *by)
            .agg(F.count(value).alias("observations"), F.kll_sketch_agg_double(F.col(value), F.lit(k)).alias("quantiles"),
                 F.hll_sketch_agg(key, lg_k).alias("keys"))
            .select(F.col("w.start").alias("step_start"), *by, "observations", "quantiles", "keys"))


def span_quantiles(sketches: DataFrame, quantiles=(0.5, 0.95, 0.99), by=(), span: str = "1 day") -> DataFrame:
    """span_start, ``by``, observations and a quantile of the raw values per span, from the sketches of its steps."""
    merged = (sketches.filter("observations > 0").groupBy(F.window("step_start", span).start.alias("span_start"), *by)
              .agg(F.sum("observations").alias("observations"), F.kll_merge_agg_double("quantiles").alias("s")))
    return merged.select("span_start", *by, "observations",
                         *[F.kll_sketch_get_quantile_double("s", F.lit(float(q))).alias(f"p{round(q * 100)}") for q in quantiles])


def span_distinct(sketches: DataFrame, by=(), span: str = "1 day") -> DataFrame:
    """span_start, ``by``, distinct_keys (estimated) per span, from the sketches of its steps."""
    merged = sketches.groupBy(F.window("step_start", span).start.alias("span_start"), *by).agg(F.hll_union_agg("keys").alias("s"))
    return merged.select("span_start", *by, F.hll_sketch_estimate("s").alias("distinct_keys"))
