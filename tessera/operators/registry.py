"""Run tracking and model registry as append-only tables.

Three Parquet datasets under one root: ``runs`` (one row per training run),
``versions`` (name, version, run, tags) and ``aliases`` (name, alias,
version, seq).  Nothing is updated in place: a new version is ``max + 1``
per name, and moving an alias appends a row -- the current alias is the
latest row per (name, alias).  A registry has a single writer.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import path_exists
from .clean import latest_per_key

VERSIONS_SCHEMA = "name string, version int, run_id string, tags map<string,string>"
ALIASES_SCHEMA = "name string, alias string, version int, seq long"
_LAST_SEQ = 0


class NoRunsError(AssertionError):
    pass


class Registry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        p = f"{self.root}/{name}"
        if path_exists(self.spark, p):
            return self.spark.read.option("mergeSchema", "true").parquet(p)
        return self.spark.createDataFrame([], schema)

    # -- runs ---------------------------------------------------------------
    def log_runs(self, runs: DataFrame) -> None:
        """Append run rows (M8); run ids are unique per run, so no dedup is needed."""
        runs.write.mode("append").parquet(f"{self.root}/runs")

    def runs(self) -> DataFrame:
        """All logged runs; raises when nothing was ever logged."""
        if not path_exists(self.spark, f"{self.root}/runs"):
            raise NoRunsError(f"no runs logged under {self.root}")
        return self.spark.read.parquet(f"{self.root}/runs")

    def search(self, experiment: str | None = None, family: str | None = None,
               metric: str = "val_f1", limit: int | None = None) -> DataFrame:
        """Runs ordered by ``metric`` descending."""
        r = self.runs()
        if experiment:
            r = r.filter(F.col("experiment") == experiment)
        if family:
            r = r.filter(F.col("tags")["model_family"] == family)
        r = r.orderBy(F.col("metrics")[metric].desc_nulls_last(), F.col("started_at").desc(), F.col("run_id"))
        return r.limit(limit) if limit else r

    def best_run(self, experiment: str | None = None, metric: str = "val_f1") -> DataFrame:
        """Top-1 run by ``metric`` over all runs of the experiment (K2, M12); raises when empty."""
        best = self.search(experiment, metric=metric, limit=1)
        if best.isEmpty():
            raise NoRunsError(f"no runs found in experiment {experiment!r}")
        return best

    # -- versions and aliases -----------------------------------------------
    def versions(self) -> DataFrame:
        return self._read("versions", VERSIONS_SCHEMA)

    def register(self, run: DataFrame, name: str, registered_by: str = "register_best_model",
                 metric: str = "val_f1") -> int:
        """New version ``max + 1`` of ``name`` for the (single) run in ``run``."""
        cur = self.versions().filter(F.col("name") == name).agg(F.max("version")).first()[0] or 0
        version = int(cur) + 1
        row = run.select(
            F.lit(name).alias("name"), F.lit(version).alias("version"), "run_id",
            F.create_map(F.lit("winning_family"), F.coalesce(F.col("tags")["model_family"], F.lit("unknown")),
                         F.lit(metric), F.format_number(F.col("metrics")[metric], 4),
                         F.lit("registered_by"), F.lit(registered_by)).alias("tags"))
        row.write.mode("append").parquet(f"{self.root}/versions")
        return version

    def aliases_log(self) -> DataFrame:
        return self._read("aliases", ALIASES_SCHEMA)

    def set_alias(self, name: str, alias: str, version: int) -> None:
        """Point ``alias`` at ``version`` (M14): append, latest row wins.  The
        single writer's nanosecond clock orders the log (no read before write)."""
        global _LAST_SEQ
        seq = max(time.time_ns(), _LAST_SEQ + 1)
        _LAST_SEQ = seq
        self.spark.createDataFrame([(name, alias, int(version), seq)], ALIASES_SCHEMA) \
            .write.mode("append").parquet(f"{self.root}/aliases")

    def aliases(self) -> DataFrame:
        """Current alias -> version per (name, alias) (latest-per-key, W1)."""
        return latest_per_key(self.aliases_log(), ["name", "alias"], ["seq"])

    def resolve(self, name: str | None = None, alias: str | None = None) -> DataFrame:
        """``models:/name@alias`` -> version -> run."""
        a = self.aliases()
        if name:
            a = a.filter(F.col("name") == name)
        if alias:
            a = a.filter(F.col("alias") == alias)
        v = self.versions()
        runs = self.runs()
        return (a.join(v, ["name", "version"], "inner")
                 .join(runs.select("run_id", "family", "params", "metrics", "model_path", "signature"),
                       "run_id", "inner"))

    def model_info(self, name: str, alias: str) -> DataFrame:
        """name, version, alias, flavor of the model an alias points to."""
        return self.resolve(name, alias).select(
            "name", F.col("version").cast("string").alias("version"), "alias",
            F.coalesce(F.col("family"), F.lit("unknown")).alias("flavor"))


def leaderboard(runs: DataFrame, metric: str = "val_f1", k: int = 10, by=()) -> DataFrame:
    """Top-k runs by metric, per group when ``by`` is given (K3)."""
    order = [F.col("metrics")[metric].desc_nulls_last(), F.col("run_id")]
    if not by:
        # distributed top-k first; the ranking window then sees only k rows
        top = runs.orderBy(*order).limit(k)
        return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    w = Window.partitionBy(*by).orderBy(*order)
    return runs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def load_by_alias(reg: Registry, name: str, alias: str, expected_schema: DataFrame | None = None):
    """Resolve ``name@alias``, load the pipeline artifact and check its input
    signature against ``expected_schema`` (M15).  Returns (model, version)."""
    import json

    from pyspark.sql import types as T

    from .quality import assert_schema
    from .train import load_model

    row = reg.resolve(name, alias).select("version", "model_path", "signature").first()
    if row is None or row.model_path is None:
        raise NoRunsError(f"{name}@{alias} does not resolve to a stored model")
    if expected_schema is not None and row.signature:
        assert_schema(expected_schema, T.StructType.fromJson(json.loads(row.signature)), allow_extra=True)
    return load_model(row.model_path), str(row.version)
