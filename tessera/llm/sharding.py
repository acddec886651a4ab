"""Sharding: contiguous shards of near-equal bytes, from global prefix sums.

Rows are range-partitioned by their order columns, the row sizes are summed per
partition, the per-partition totals are turned into prefix sums (a table of one
row a partition), and each row's global start byte is its partition's prefix plus
a running sum inside the partition.  The byte line is then cut at equal targets.

DataFrame functions only.  The range-partitioned rows are staged once, so the
partition numbers that the sums rest on cannot change when a task is run again.

Defined cases: shards are contiguous in the order columns (nulls first), ties
broken arbitrarily but once; repeated rows each take their own slot; every row is
placed, whatever its text (a null text has no bytes); an empty table gives no
rows.  A shard's bytes differ from the target by less than the largest row, so
shards are empty only when rows are fewer or larger than the targets.

Scale: the only shuffle of the rows is the range partitioning, which samples for
equal partitions; equal order keys are spread by a last random column, so a key
that holds a third of the rows still splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged


def shard_by_bytes(rows: DataFrame, n_shards: int, size: Column, order: list[str]) -> DataFrame:
    """``rows`` plus ``shard`` (int) and ``slot`` (long, gapless from 0 in the shard).

    ``size`` is the row's weight in bytes; ``order`` the columns of the global order.
    """
    spark = rows.sparkSession
    data = rows.drop("shard", "slot").withColumns({"__sh_size": size.cast("long"), "__sh_tie": F.rand(42)})
    keys = [F.col(c) for c in order] + [F.col("__sh_tie")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = staged(data.repartitionByRange(parts, *keys).withColumn("__sh_part", F.spark_partition_id()), "shard-rows")

    # one row a partition: its bytes and rows, then what lies before it
    before = Window.orderBy("__sh_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("__sh_part").agg(F.sum("__sh_size").alias("b"), F.count("*").alias("n"))
    prefix = totals.select(
        "__sh_part", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("__sh_b0"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__sh_n0"),
        F.sum("b").over(Window.partitionBy()).alias("__sh_total"))

    inside = Window.partitionBy("__sh_part").orderBy(*keys)
    running = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = (dealt.join(F.broadcast(prefix), "__sh_part")  # as many rows as shuffle partitions
              .withColumn("__sh_at", F.col("__sh_b0") + F.coalesce(F.sum("__sh_size").over(running), F.lit(0)))
              .withColumn("__sh_row", F.col("__sh_n0") + F.row_number().over(inside) - 1)
              # the shard whose target holds the row's middle byte
              .withColumn("shard", F.expr(
                  f"least({n_shards - 1}, (__sh_at + __sh_size div 2) div "
                  f"greatest(1, (__sh_total + {n_shards - 1}) div {n_shards}))").cast("int")))
    firsts = placed.groupBy(F.col("shard").alias("__sh_of")).agg(F.min("__sh_row").alias("__sh_first"))
    out = (placed.join(F.broadcast(firsts), F.col("shard") == F.col("__sh_of"))  # n_shards rows
           .withColumn("slot", F.col("__sh_row") - F.col("__sh_first")))
    return out.select(*[f"`{c}`" for c in rows.columns if c.lower() not in ("shard", "slot")], "shard", "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard (``shard=N``), rows in slot order."""
    (sharded.repartition("shard").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
