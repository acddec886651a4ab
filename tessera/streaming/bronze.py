"""Landing folder -> Bronze as a Structured Streaming query.

The file source remembers the files it has processed in the checkpoint,
so a re-run picks up only new files; the Parquet file sink commits each
micro-batch exactly once.  ``availableNow`` processes everything present
and stops -- and unlike the notebook we wait for it before anyone reads
Bronze (X5).
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.landing import (CORRUPT, UNKNOWN_LAYOUT, csv_options, parse_by_layout, raw_schema, table_columns,
                               track_layouts, with_audit, with_headers)
from .runner import ProgressTotals, finish


def bronze_source(spark: SparkSession, landing: str, schema: T.StructType | None = None,
                  header: bool = True, sep: str = ",", max_files_per_trigger: int | None = None) -> DataFrame:
    schema = schema or raw_schema()
    n = len([f for f in schema.fields if f.name != CORRUPT])
    # landing zones are often foldered by day: pick files up at any depth
    reader = (spark.readStream.schema(schema).options(**csv_options(header, sep))
                   .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return with_audit(reader.csv(landing), n, sep)


def _run(spark: SparkSession, rows: DataFrame, bronze_path: str, checkpoint: str, timeout_s: int | None) -> dict:
    totals = ProgressTotals()
    spark.streams.addListener(totals)
    try:
        q = (rows.writeStream.format("parquet")
                 .option("checkpointLocation", checkpoint)
                 .outputMode("append")
                 .trigger(availableNow=True)
                 .start(bronze_path))
        finish(q, timeout_s)
        batches, count = totals.of(q)
    finally:
        spark.streams.removeListener(totals)
    return {"batches": batches, "input_rows": count}


def ingest_available(spark: SparkSession, landing: str, bronze_path: str, checkpoint: str,
                     schema: T.StructType | None = None, header: bool = True, sep: str = ",",
                     max_files_per_trigger: int | None = None, timeout_s: int | None = None) -> dict:
    """Run the Bronze stream over every file not seen yet, then stop (availableNow).
    All files share one layout, bound by position; see ``ingest_tracking_schema`` for others."""
    return _run(spark, bronze_source(spark, landing, schema, header, sep, max_files_per_trigger),
                bronze_path, checkpoint, timeout_s)


def ingest_tracking_schema(spark: SparkSession, landing_dir: str, bronze_path: str, checkpoint: str,
                           schema_location: str, sep: str = ",", max_files_per_trigger: int | None = None,
                           timeout_s: int | None = None, attempts: int = 3) -> dict:
    """Bronze ingest with schema tracking (S3): columns bind by each file's own header.

    The header of every new file is noted below ``schema_location`` before the stream
    runs, so files with fewer, more, reordered or quoted columns are all read right;
    readers of Bronze use ``mergeSchema``.  A file that lands in between fails its
    micro-batch, which is run again once its header is noted.
    """
    for attempt in range(attempts):
        headers = track_layouts(spark, landing_dir, schema_location)
        columns = table_columns(headers, sep=sep)
        if not headers:
            return {"batches": 0, "input_rows": 0, "columns": list(columns)}
        reader = spark.readStream.option("recursiveFileLookup", "true")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        lines = with_headers(reader.text(landing_dir), spark.read.parquet(schema_location))
        rows = parse_by_layout(lines, headers, columns, sep).observe(
            "bronze_rows", F.count(F.lit(1)).alias("rows"))  # the source counts header lines too
        try:
            out = _run(spark, rows, bronze_path, checkpoint, timeout_s)
        except StreamingQueryException as e:
            if UNKNOWN_LAYOUT not in str(e) or attempt == attempts - 1:
                raise
            continue
        out["columns"] = list(columns)
        return out
