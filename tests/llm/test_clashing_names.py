"""Extra columns whose names differ from an operator's own in case only, or that it uses inside."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tessera.llm import line_dedup, quality, sharding

EXTRA = ["sid", "SH", "sy", "Y", "N_lines", "Removed_Spans", "Shard", "SLOT", "score", "digest", "cid", "tile", "held"]


@pytest.fixture(scope="module")
def docs(spark):
    good, bad = "the report gives the figures of the year and explains them", "buy now cheap cheap click here $$$ !!!"
    rows = [(i, f"{good if i % 2 else bad} {i * 37 % 101} " * 6, *["x"] * len(EXTRA)) for i in range(60)]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in EXTRA))


def written(df, tmp_path):
    df.write.parquet(f"{tmp_path}/out")
    return df.sparkSession.read.parquet(f"{tmp_path}/out")


def test_line_dedup(docs, tmp_path):
    out = written(line_dedup.dedup_lines(docs), tmp_path)
    assert out.count() == 60 and len({c.lower() for c in out.columns}) == len(out.columns) and "n_lines" in out.columns


def test_sharding(docs, tmp_path):
    out = written(sharding.shard_by_bytes(docs, 4, F.length("text"), ["doc_id"]), tmp_path)
    assert out.count() == 60 and {r[0] for r in out.select("shard").collect()} == {0, 1, 2, 3}


def test_quality_and_its_stage(spark, docs, tmp_path):
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    model = quality.fit(docs, labels, F.lit(True))
    assert model.weights and quality.score_quality(docs, model).filter("score BETWEEN 0 AND 1").count() == 60
    kept = dict(cp.STAGES)["quality"](spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and {r.score for r in kept.collect()} == {"x"} and 0 < kept.count() < 60
