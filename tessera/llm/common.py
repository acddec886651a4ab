"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package, work_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the
    planner the real size of what follows.
    """
    path = work_path(df.sparkSession, "llm", name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def prepared(spark: SparkSession) -> None:
    """Ship the package to the Python workers of this application, and keep batches of long texts small.

    Spark's own bound of 64 MB a batch is held several times over (JVM, Arrow, Python objects) in every running
    task; a smaller value that the session already has stays.
    """
    ship_package(spark)
    if spark.conf.get(ARROW_BYTES, "67108864b") == "67108864b":
        spark.conf.set(ARROW_BYTES, "8m")


def text_hash(text_col: str):
    """64-bit hash of a text; null and empty differ."""
    return F.xxhash64(F.col(text_col).isNull(), F.col(text_col))


def raw_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a text column, null as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b or b"" for b in column.cast(kind).to_pylist()]


def sliced(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose text stays near ``most_bytes`` (one row at least)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        per_row = column.nbytes // max(1, len(column)) + 1
        step = max(1, most_bytes // per_row)
        for at in range(0, len(batch), step):
            yield batch.slice(at, step)


def over(df: DataFrame, **columns) -> DataFrame:
    """Set columns, replacing input columns whose name differs only in case."""
    taken = {c.lower() for c in columns}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken],
                     *[v.alias(k) for k, v in columns.items()])
