"""Bronze -> Silver incrementally (S20): a stream over the Bronze files whose
``foreachBatch`` cleans the new rows and upserts them into Silver (latest row
per key over current Silver + the batch).

Silver is either a ``BucketedTable`` (default: a batch rewrites only the key
buckets it touches) or a ``VersionedDataset`` (every batch writes a complete
new snapshot).  Both are idempotent, so a batch retried after a failure
gives the same Silver; the quarantine append is keyed, so retries add
nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators.clean import normalize_churn, row_hash, upsert_latest
from ..operators.quality import enforce_gates, quality_report, quarantine_split, unexpected_columns
from ..sources.landing import CORRUPT
from ..sources.tables import BucketedTable, VersionedDataset, append_new
from .runner import finish

RECENCY = ["_ingest_ts", "_source_file", "_row_hash"]


def silver_batch(silver, quarantine_path: str, gold: BucketedTable | None = None, gold_kw: dict | None = None, declared=(),
                 extra: str = "fail"):
    """The ``foreachBatch`` function of the Silver stream.  With a bucketed
    ``gold`` table (same keys and bucket count as Silver), the Gold rows of
    the touched buckets are recomputed too, so Gold follows Silver
    incrementally."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        unexpected = unexpected_columns(batch.columns, declared, extra)
        batch = batch.persist()     # read for the touched buckets, the merge and the quarantine
        try:
            process(spark, batch, unexpected)
        finally:
            batch.unpersist()

    def gate(written: DataFrame) -> None:
        # Silver's uniqueness and non-empty gates (V2, V3) on the buckets about to become current
        enforce_gates(quality_report(written, C.ID_COLUMN, (C.ID_COLUMN,)))

    def process(spark: SparkSession, batch: DataFrame, unexpected: list[str]) -> None:
        bad, good = quarantine_split(batch, unexpected=unexpected)
        typed = normalize_churn(good).withColumn("_row_hash", row_hash(C.RAW_COLUMNS))
        typed = typed.drop(*[c for c in (CORRUPT, "_rescued_data") if c in typed.columns])
        if isinstance(silver, BucketedTable):
            touched = silver.upsert(typed, RECENCY, gate=gate)
            if gold is not None and touched:
                from ..operators.features import gold_features

                feats = gold_features(silver.read_buckets(touched), **(gold_kw or {}))
                gold.replace(feats.withColumn("_bucket", gold.bucket()))
        else:
            silver.write(upsert_latest(silver.read(), typed, C.ID_COLUMN, RECENCY), gate=gate)
        q = bad.withColumn("_q_hash", F.xxhash64(*[F.col(c) for c in C.RAW_COLUMNS + (CORRUPT,)]))
        # a micro-batch holds a bounded set of new files: check only their keys
        append_new(spark, quarantine_path, q, ["_source_file", "_q_hash"], scope_col="_source_file")

    return run


def run_silver_stream(spark: SparkSession, bronze_path: str, bronze_schema, silver: BucketedTable | VersionedDataset,
                      quarantine_path: str, checkpoint: str, max_files_per_trigger: int | None = None,
                      timeout_s: int | None = None, gold: BucketedTable | None = None,
                      gold_kw: dict | None = None, declared=(), extra: str = "fail") -> None:
    """``extra``: what becomes of columns that are neither the landing contract's nor ``declared`` (see ``unexpected_columns``)."""
    if not isinstance(bronze_schema, str):
        unexpected_columns(bronze_schema.names, declared, extra)  # fails before the stream starts
    reader = spark.readStream.schema(bronze_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    q = (reader.parquet(bronze_path).writeStream
               .foreachBatch(silver_batch(silver, quarantine_path, gold, gold_kw, declared, extra))
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    finish(q, timeout_s)
