"""Silver cleaning: lenient typing, normalisation, latest row per key, upsert
(F1-F6, P1-P3, W1, S13, S20).

``latest_per_key`` is the only shuffle of the Silver job.  Two physical
forms are offered:

* ``"aggregate"`` (default) -- ``max_by(struct(payload), struct(recency))``
  per key.  The aggregate runs partial-then-final, so every map task first
  reduces its own rows to one per key; a key holding a third of all rows
  ships one row per map task, not a third of the data, into one reducer.
* ``"window"`` -- ``row_number() over (partition by key order by recency desc) = 1``.
  Catalyst adds a partial ``WindowGroupLimit`` before the shuffle, which
  bounds a hot key the same way, but both sides sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.casts import lenient_double, lenient_int, norm_text, yes_label


def normalize_churn(clean: DataFrame) -> DataFrame:
    """Type and normalise the raw churn columns in one projection.

    Columns other than the 14 raw ones pass through unchanged, in place.
    """
    exprs = {C.ID_COLUMN: F.trim(F.col(C.ID_COLUMN))}
    for c in C.TEXT_COLUMNS:
        exprs[c] = norm_text(c)
    for c in C.INT_COLUMNS:
        exprs[c] = lenient_int(c)
    for c in C.DOUBLE_COLUMNS:
        exprs[c] = lenient_double(c)
    exprs[C.LABEL_COLUMN] = yes_label(C.LABEL_COLUMN)
    return clean.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in clean.columns])


def latest_per_key(df: DataFrame, keys, recency, strategy: str = "aggregate") -> DataFrame:
    """Keep one row per key: the one with the greatest ``recency`` tuple.

    ``recency`` lists columns compared in order, all descending; add
    tie-breakers (file, row hash) to make the winner deterministic (X7).
    NULL recency values lose against any non-NULL value.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    recency = [recency] if isinstance(recency, str) else list(recency)
    if strategy == "window":
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in recency])
        return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    if strategy != "aggregate":
        raise ValueError(f"unknown strategy {strategy!r}")
    payload = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(c) for c in payload]),
                    F.struct(*[F.col(c) for c in recency])).alias("_best")
    return (df.groupBy(*keys).agg(best)
              .select(*keys, *[F.col("_best")[c].alias(c) for c in payload])
              .select(*df.columns))


def row_hash(cols) -> Column:
    """Stable content hash of a row, used as the last tie-breaker and as the
    idempotence key of appends (xxhash64 over the listed columns)."""
    return F.xxhash64(*[F.col(c) for c in cols])


def upsert_latest(current: DataFrame | None, incoming: DataFrame, keys, recency,
                  strategy: str = "aggregate") -> DataFrame:
    """MERGE-free upsert: latest row per key over current ∪ incoming.

    The result is meant to be written as a new dataset version (see
    ``sources.tables.VersionedDataset``), never over the table it reads.
    """
    both = incoming if current is None else current.unionByName(incoming, allowMissingColumns=True)
    return latest_per_key(both, keys, recency, strategy)


def silver_from_bronze(bronze: DataFrame, quarantined_at=None, strategy: str = "aggregate", declared=(), extra: str = "fail"):
    """Bronze -> (silver, quarantine): schema check, reject split, typing, latest per id,
    technical columns dropped (the whole of the Silver job, S21, P4-P5, F1-F6, W1)."""
    from .quality import quarantine_split, unexpected_columns

    quarantine, clean = quarantine_split(bronze, quarantined_at, unexpected=unexpected_columns(bronze.columns, declared, extra))
    typed = normalize_churn(clean).withColumn("_row_hash", row_hash(C.RAW_COLUMNS))
    latest = latest_per_key(typed, C.ID_COLUMN, ["_ingest_ts", "_source_file", "_row_hash"], strategy)
    drop = [c for c in ("_row_hash", "_corrupt_record", "_rescued_data") if c in latest.columns]
    return latest.drop(*drop), quarantine
