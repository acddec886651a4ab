"""Parquet datasets with Delta-like write semantics.

Plain Parquet has no MERGE, no schema-merging append into a catalog table
and no overwrite of a table that the same plan reads.  The answers here:

* ``VersionedDataset`` -- every overwrite goes to a new immutable version
  folder; the current version is the newest one with a ``_COMMITTED`` marker,
  set after its gate, so a failed or half-written job is never visible, and a re-run
  after a lost executor simply writes the next version (S11, S13).
* ``append_new`` -- append only rows whose idempotence key is not present
  yet (left-anti join), so re-running a job does not duplicate rows (S12, X6).
* ``read_merged`` -- path datasets read with ``mergeSchema`` (S9).
* ``BucketedTable`` -- key-bucketed dataset upserted bucket by bucket: a commit writes
  the buckets it touches beside the old ones, then one manifest (S13).
* ``create_layers`` / ``register_table`` -- layer schemas and external
  tables in the session catalog (S14).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import config as C


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def _create(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in one step: whole under its name, or absent; fails if it exists."""
    fs, p, jvm = _fs(spark, path)
    temporary = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(temporary, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if fs.exists(p) or not fs.rename(temporary, p):
        fs.delete(temporary, False)
        raise FileExistsError(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file through Hadoop's filesystem, replacing one of that name."""
    fs, p, _ = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


class VersionedDataset:
    """Immutable version folders ``<root>/v00001, v00002, ...``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def versions(self) -> list[int]:
        """Committed versions: written completely and passed by their gate (``_COMMITTED``)."""
        return sorted(int(name[1:]) for name in list_dirs(self.spark, self.root)
                      if name.startswith("v") and name[1:].isdigit()
                      and path_exists(self.spark, f"{self.root}/{name}/_COMMITTED"))

    def retain(self, keep: int) -> list[int]:
        """Delete all but the newest ``keep`` committed versions (and any
        uncommitted or rejected folder older than them); the current version
        is never removed.  Returns the deleted version numbers."""
        if keep < 1:
            raise ValueError("keep must be >= 1")
        committed = self.versions()
        if len(committed) <= keep:
            return []
        oldest_kept = committed[-keep]
        fs, _, jvm = _fs(self.spark, self.root)
        gone = []
        for name in list_dirs(self.spark, self.root):
            if name.startswith("v") and name[1:].isdigit() and int(name[1:]) < oldest_kept:
                fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}"), True)
                gone.append(int(name[1:]))
        return sorted(gone)

    def current_version(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def version_path(self, version: int) -> str:
        return f"{self.root}/v{version:05d}"

    def read(self, version: int | None = None) -> DataFrame | None:
        v = self.current_version() if version is None else version
        return None if v is None else self.spark.read.parquet(self.version_path(v))

    def write(self, df: DataFrame, partition_by: tuple[str, ...] = (), gate=None) -> int:
        """Write ``df`` as the next version; schema changes are allowed (overwriteSchema).

        ``gate`` is called with the written rows; nobody sees the version before it has
        returned.  If it raises, or the job dies, the files stay for inspection only.
        """
        taken = [int(n[1:]) for n in list_dirs(self.spark, self.root) if n[1:].isdigit()]
        v = (max(taken) if taken else 0) + 1
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.version_path(v))
        if gate is not None:
            gate(self.read(v))
        _create(self.spark, f"{self.version_path(v)}/_COMMITTED", "")
        return v


def read_merged(spark: SparkSession, *paths: str) -> DataFrame:
    """Read Parquet datasets whose files carry different column sets."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def append_new(spark: SparkSession, path: str, df: DataFrame, key_cols, scope_col: str | None = None) -> DataFrame:
    """Append the rows of ``df`` whose key is not stored yet; returns what was appended.

    The anti-join reads only the key columns of the existing data; new
    columns are allowed (readers use ``mergeSchema``).  ``scope_col`` limits
    the existing keys to the values of that column present in ``df`` (e.g.
    the source files of one micro-batch, a bounded list), so the check costs
    the batch, not the history.  (S12, X6)
    """
    from pyspark.sql import functions as F

    key_cols = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    new = df
    if path_exists(spark, path):
        existing = read_merged(spark, path).select(*key_cols)
        if scope_col is not None:
            scope = [r[0] for r in df.select(scope_col).distinct().collect()]
            existing = existing.filter(F.col(scope_col).isin(scope))
        new = df.join(existing, key_cols, "left_anti")
    # Stage the new rows once so the write and the returned frame agree even
    # if the source changes between actions.
    new = new.checkpoint(eager=True)
    new.write.mode("append").parquet(path)
    return new


def create_layers(spark: SparkSession, project: str = "churn", comments: dict | None = None) -> DataFrame:
    """``CREATE SCHEMA IF NOT EXISTS`` for the medallion layers.

    OSS Spark has no three-level catalogs, so the project becomes a name
    prefix: ``<project>_bronze``, ``<project>_silver``, ...  Returns the
    ``SHOW SCHEMAS`` rows of those layers.
    """
    comments = comments or C.LAYER_SCHEMAS
    names = []
    for layer, comment in comments.items():
        name = f"{project}_{layer}"
        safe = comment.replace("'", "''")
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} COMMENT '{safe}'")
        names.append(name)
    shown = spark.sql("SHOW SCHEMAS")
    col = shown.columns[0]
    return shown.filter(shown[col].isin(names)).withColumnRenamed(col, "schema_name")


class BucketedTable:
    """Key-bucketed Parquet dataset upserted bucket by bucket (S13 at scale).

    Rows live under ``_commit=<n>/_bucket=<b>`` with ``b = pmod(xxhash64(key), buckets)``.
    An upsert reads only the buckets that the incoming rows touch, keeps the latest row
    per key over current + incoming and writes those buckets into a new commit folder.
    Then ``_manifest/<n>.json`` (the table's columns, and bucket -> commit, at most
    ``buckets`` numbers) makes the commit current in one step; columns that appear later
    are NULL in older buckets, and no read opens footers to learn the schema.  A job that dies before that leaves the table as it was;
    nothing is overwritten, so a reader keeps what it opened until ``retain`` drops it.
    Re-running a batch gives the same rows, since latest-per-key is idempotent.

    The cost follows the touched buckets.  A batch of more keys than buckets touches
    nearly all: size ``buckets`` so that a bucket is about what a task writes anyway.
    """

    def __init__(self, spark: SparkSession, path: str, keys, buckets: int = 256):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys = [keys] if isinstance(keys, str) else list(keys)
        self.buckets = buckets

    def bucket(self):
        from pyspark.sql import functions as F

        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def commits(self) -> list[int]:
        fs, p, _ = _fs(self.spark, f"{self.path}/_manifest")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def manifest(self, commit: int | None = None) -> tuple[T.StructType, dict[int, int]]:
        """The table's columns and bucket -> the commit that wrote it, as of ``commit`` (default: the newest)."""
        if commit is None:
            commit = (self.commits() or [0])[-1]
        if not commit:
            return T.StructType(), {}
        fs, p, jvm = _fs(self.spark, f"{self.path}/_manifest/{commit:08d}.json")
        stream = fs.open(p)
        try:
            text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        held = json.loads(text)
        return T.StructType.fromJson(held["columns"]), {int(b): c for b, c in held["buckets"].items()}

    def exists(self) -> bool:
        return bool(self.commits())

    def _folder(self, commit: int) -> str:
        return f"{self.path}/_commit={commit}"

    def _read(self, columns: T.StructType, at: dict[int, int]) -> DataFrame:
        paths = [f"{self._folder(c)}/_bucket={b}" for b, c in sorted(at.items())]
        schema = T.StructType([*columns.fields, T.StructField("_bucket", T.IntegerType())])
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths).drop("_commit")

    def read(self, commit: int | None = None) -> DataFrame:
        return self._read(*self.manifest(commit))

    def read_buckets(self, buckets) -> DataFrame:
        """The rows of the given buckets; the columns are those of the table."""
        from pyspark.sql import functions as F

        return self.read().filter(F.col("_bucket").isin(list(buckets)))

    def upsert(self, incoming: DataFrame, recency, strategy: str = "aggregate", gate=None) -> list[int]:
        """Merge ``incoming`` (latest row per key wins); returns the touched buckets."""
        from pyspark.sql import functions as F

        from ..operators.clean import latest_per_key

        inc = incoming.withColumn("_bucket", self.bucket())
        both = inc
        if self.exists():
            touched = [r[0] for r in inc.select("_bucket").distinct().collect()]   # <= buckets ints
            both = self.read_buckets(touched).unionByName(inc, allowMissingColumns=True)
        return self.replace(latest_per_key(both, self.keys + ["_bucket"], recency, strategy), gate)

    def replace(self, df: DataFrame, gate=None) -> list[int]:
        """Replace exactly the buckets present in ``df`` (which carries ``_bucket``); returns them.
        ``gate`` is called with the written buckets before they become current."""
        commits = self.commits()
        # beyond every commit folder too: a dead job may have left one without a manifest
        left = [int(n.split("=")[1]) for n in list_dirs(self.spark, self.path) if n.startswith("_commit=")]
        commit = max([0, *commits, *left]) + 1
        # one bucket's rows meet before the write (large buckets are split), else every task writes every bucket
        df.hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(self._folder(commit))
        written = sorted(int(n.split("=")[1]) for n in list_dirs(self.spark, self._folder(commit)) if n.startswith("_bucket="))
        if not written:
            return []
        new = dict.fromkeys(written, commit)
        old_columns, old = self.manifest(commits[-1] if commits else 0)
        own = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema if f.name != "_bucket"])
        if changed := [f.name for f in own if f.name in old_columns.names and old_columns[f.name].dataType != f.dataType]:
            raise TypeError(f"columns of another type than the table's: {changed}")
        if gate is not None:
            gate(self._read(own, new))
        columns = T.StructType(old_columns.fields + [f for f in own if f.name not in old_columns.names])
        _create(self.spark, f"{self.path}/_manifest/{commit:08d}.json",
                json.dumps({"columns": columns.jsonValue(), "buckets": {**old, **new}}))
        return written

    def retain(self, keep: int) -> None:
        """Drop all but the newest ``keep`` manifests and the bucket folders none of them names."""
        if keep < 1:
            raise ValueError("keep must be >= 1")
        commits = self.commits()
        named = {(c, b) for m in commits[-keep:] for b, c in self.manifest(m)[1].items()}
        fs, _, jvm = _fs(self.spark, self.path)
        for m in commits[:-keep]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/_manifest/{m:08d}.json"), False)
        for name in list_dirs(self.spark, self.path):
            if name.startswith("_commit=") and commits and (c := int(name.split("=")[1])) <= commits[-1]:
                for sub in list_dirs(self.spark, self._folder(c)):
                    if sub.startswith("_bucket=") and (c, int(sub.split("=")[1])) not in named:
                        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self._folder(c)}/{sub}"), True)


def register_table(spark: SparkSession, schema: str, table: str, path: str) -> str:
    """Expose a Parquet dataset as ``schema.table`` (external: dropping the
    name never deletes data).  Re-registering points the name at ``path``."""
    name = f"{schema}.{table}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    if spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = '# Partition Information'").count():
        spark.sql(f"REPAIR TABLE {name}")      # register the partition folders with the catalog
    return name
