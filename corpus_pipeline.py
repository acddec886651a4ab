"""The corpus pipeline: documents to packed training sequences, in five stages.

Each stage is ``function(spark, docs, sf_dir) -> DataFrame``; ``run`` writes a stage's
result as Parquet below the shared folder and hands the reread table to the next.  All
stages but the last return the columns of ``documents``.

1. ``quality``        documents scored below 0.3 go
2. ``line_dedup``     lines covered by repeated three-line windows go; documents stay
3. ``near_dedup``     one document of each SimHash component stays, the smallest id
4. ``decontaminate``  benchmark spans are cut out; documents that are half benchmark go
5. ``pack``           documents become packed sequences, one row per piece, with ids
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, line_dedup, packing, quality, simhash
from tessera.llm.catalog import NOT_HELD_OUT
from tessera.llm.common import staged, table

#: Documents with a lower score than this are rejected.
MIN_QUALITY = 0.3


def _like_documents(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with ``n_chars`` true to the text."""
    if "n_chars" in docs.columns:
        df = df.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return df.select(*[f"`{c}`" for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"), F.expr(NOT_HELD_OUT.format("doc_id", 5)))
    if not model.weights:
        return docs.select("*")
    # the row as one column, so that a document column named like the score stays as it is
    whole = docs.select(F.struct("*").alias("__row"), F.col("text").alias("__text"))
    return quality.score_quality(whole, model, "__text").filter(F.col("score") >= MIN_QUALITY).select("__row.*")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _like_documents(line_dedup.dedup_lines(docs), docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, words=3, max_bits=2)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _like_documents(decontaminate.clean(docs, table(spark, sf_dir, "benchmark")), docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, with_ids=True, remembered=250_000)  # beside what earlier stages left in the workers


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("pack", pack_stage),
]

#: Compression, fingerprints and tokenisation have no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
