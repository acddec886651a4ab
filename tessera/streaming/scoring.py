"""Stream scoring (C5): records arriving as files are checked against the
contract, scored and appended as prediction envelopes; rejected records go
to their own dataset with the error list.  One ``foreachBatch`` writes both,
each append keyed by the batch id so a retried batch replaces nothing twice.

With a registered model (J1) the alias is resolved once per micro-batch, so a moved alias takes effect with the next batch,
without a restart.  What a batch is scored with is committed before anything of it is written: a batch that is
replayed after a failure keeps its own version even if the alias has moved in between."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.registry import NoRunsError, Registry
from ..operators.score import contract_then_score, envelope_of, score_model, score_rule
from ..operators.train import load_model
from ..sources.tables import VersionedDataset
from .runner import finish


def _write_batch(batch: DataFrame, batch_id: int, out: str, key: str, model_version: str, model_name: str, predictor) -> None:
    scored, bad = contract_then_score(batch, keep=(key,), predictor=predictor)
    env = envelope_of(scored, key, model_version, model_name, keep=(key,))
    # one folder per batch id: a replayed batch overwrites its own output only
    env.write.mode("overwrite").parquet(f"{out}/scored/batch={batch_id}")
    bad.withColumn("_errors", F.array_join("_errors", "; ")) \
       .write.mode("overwrite").parquet(f"{out}/rejected/batch={batch_id}")


def score_batch(out: str, key: str, model_version: str, model_name: str, predictor=score_rule):
    def run(batch: DataFrame, batch_id: int) -> None:
        _write_batch(batch, batch_id, out, key, model_version, model_name, predictor)
    return run


def pinned_model(registry: Registry, out: str, batch_id: int, name: str, alias: str) -> tuple[str, str]:
    """(version, model path) that a batch is scored with: what the alias points to when the batch first runs."""
    pinned = VersionedDataset(registry.spark, f"{out}/models/batch={batch_id}")
    if not pinned.versions():
        found = registry.resolve(name, alias).select(F.col("version").cast("string").alias("version"), "model_path")
        if found.filter("model_path IS NOT NULL").isEmpty():
            raise NoRunsError(f"{name}@{alias} does not resolve to a stored model")
        pinned.write(found.coalesce(1))
    row = pinned.read(pinned.versions()[0]).first()
    return row.version, row.model_path


def score_registered_batch(registry: Registry, out: str, key: str, name: str, alias: str = "production", kept_models: int = 2):
    """The ``foreachBatch`` function; the last ``kept_models`` versions stay loaded."""
    models: dict[str, object] = {}

    def run(batch: DataFrame, batch_id: int) -> None:
        version, path = pinned_model(registry, out, batch_id, name, alias)
        if path not in models:
            if len(models) >= kept_models:
                models.pop(next(iter(models)))
            models[path] = load_model(path)
        _write_batch(batch, batch_id, out, key, version, name, lambda df: score_model(df, models[path]))
    return run


def run_scoring_stream(spark: SparkSession, records_path: str, schema, out: str, checkpoint: str,
                       key: str, model_version: str = "0", model_name: str = "mock",
                       max_files_per_trigger: int | None = None, timeout_s: int | None = None,
                       predictor=score_rule) -> None:
    """Score arriving record files.  ``predictor`` and the envelope metadata can come
    from ``operators.score.choose_predictor`` (rule or registered model, C4)."""
    _run(spark, records_path, schema, checkpoint, score_batch(out, key, model_version, model_name, predictor), max_files_per_trigger, timeout_s)


def run_registered_scoring(spark: SparkSession, registry: Registry, name: str, records_path: str, schema, out: str, checkpoint: str,
                           key: str, alias: str = "production", max_files_per_trigger: int | None = None,
                           timeout_s: int | None = None) -> None:
    """Score arriving record files with whatever ``name@alias`` points to at each micro-batch."""
    _run(spark, records_path, schema, checkpoint, score_registered_batch(registry, out, key, name, alias), max_files_per_trigger, timeout_s)


def _run(spark: SparkSession, records_path: str, schema, checkpoint: str, each_batch, max_files_per_trigger, timeout_s) -> None:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    q = (reader.parquet(records_path).writeStream.foreachBatch(each_batch)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finish(q, timeout_s)
