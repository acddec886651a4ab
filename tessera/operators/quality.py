"""Quarantine, quality gates and record contracts.

Every check is an expression or one aggregation over the data; gates read
a single-row result back to the driver, never the data itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions.casts import blank_or_null


class QualityGateError(AssertionError):
    """Raised when a gate fails; the message carries the measured numbers."""


def split_by(df: DataFrame, cond: Column) -> tuple[DataFrame, DataFrame]:
    """Exact complement split: rows where ``cond`` holds, and all the others.

    ``cond`` is made NULL-safe first, so a NULL predicate lands on the
    second side instead of vanishing from both.
    """
    c = F.coalesce(cond, F.lit(False))
    return df.filter(c), df.filter(~c)


#: Columns that a Bronze row carries beside the landing file's own.
TECHNICAL_COLUMNS = ("_corrupt_record", "_rescued_data", "_ingest_ts", "_source_file")


def unexpected_columns(columns, declared=(), extra: str = "fail") -> list[str]:
    """Columns of Bronze that Silver's contract does not name (S21): neither landing columns nor ``declared`` ones.

    ``extra`` says what becomes of them: ``fail`` raises, before anything is written; ``quarantine`` sets the rows aside that hold a
    value in one of them; ``keep`` lets them through, as a schema-merging append would.
    """
    if extra not in ("fail", "quarantine", "keep"):
        raise ValueError(f"extra columns: fail, quarantine or keep, not {extra!r}")
    named = {c.lower() for c in (*C.RAW_COLUMNS, *TECHNICAL_COLUMNS, *declared)}
    missing = sorted(named - {c.lower() for c in columns} - {c.lower() for c in (*TECHNICAL_COLUMNS, *declared)})
    found = [] if extra == "keep" else [c for c in columns if c.lower() not in named]
    if missing or (found and extra == "fail"):
        raise QualityGateError(f"schema mismatch at Silver: missing={missing} extra={found}")
    return found


def reject_reason(id_col: str = C.ID_COLUMN, corrupt_col: str = "_corrupt_record") -> Column:
    """First failing rule of the Bronze reject predicate, NULL when the row is clean."""
    return (F.when(F.col(corrupt_col).isNotNull(), F.lit("corrupt_record"))
             .when(F.col(id_col).isNull(), F.lit("missing_id"))
             .when(F.trim(F.col(id_col)) == "", F.lit("blank_id")))


def _holds_any(columns) -> Column:
    return F.coalesce(*[F.col(f"`{c}`").cast("string") for c in columns]).isNotNull() if columns else F.lit(False)


def reject_condition(id_col: str = C.ID_COLUMN, corrupt_col: str = "_corrupt_record") -> Column:
    """corrupt OR id NULL OR blank id -- never NULL, so its negation is the exact complement."""
    return F.col(corrupt_col).isNotNull() | blank_or_null(F.col(id_col))


def quarantine_split(bronze: DataFrame, quarantined_at=None, id_col: str = C.ID_COLUMN,
                     corrupt_col: str = "_corrupt_record", unexpected=()) -> tuple[DataFrame, DataFrame]:
    """Split Bronze into (quarantine, clean); quarantine keeps the raw columns plus
    ``_quarantined_at`` (one timestamp per batch) and ``_reject_reason`` (V1).

    Rows with a value in an ``unexpected`` column are set aside with it; the clean side has none of these columns."""
    ts = F.current_timestamp() if quarantined_at is None else F.lit(quarantined_at).cast("timestamp")
    bad, good = split_by(bronze, reject_condition(id_col, corrupt_col) | _holds_any(unexpected))
    reason = F.coalesce(reject_reason(id_col, corrupt_col), F.when(_holds_any(unexpected), F.lit("unexpected_columns")))
    bad = bad.withColumns({"_quarantined_at": ts, "_reject_reason": reason})
    return bad, good.drop(*unexpected)


def quality_report(df: DataFrame, key: str, required: tuple[str, ...] = (),
                   approx_rsd: float | None = None) -> DataFrame:
    """One-row report in a single pass: rows, distinct keys, NULLs per required column,
    and the gate verdicts (A2, A3, V2-V4).

    ``approx_rsd`` switches the distinct count to ``approx_count_distinct``
    (HyperLogLog, no shuffle of keys) for monitoring; the exact count stays
    the gate's default.
    """
    distinct = (F.count_distinct(F.col(key)) if approx_rsd is None
                else F.approx_count_distinct(F.col(key), approx_rsd))
    aggs = [F.count(F.lit(1)).alias("row_count"),
            distinct.alias("distinct_keys"),
            F.count_if(F.col(key).isNull()).alias("null_keys")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in required]
    # distinct().count() counts NULL as one more value; count_distinct does not.
    rep = df.agg(*aggs).withColumn(
        "distinct_keys", F.col("distinct_keys") + F.least(F.col("null_keys"), F.lit(1)))
    null_total = F.lit(0)
    for c in required:
        null_total = null_total + F.col(f"nulls_{c}")
    return rep.withColumns({
        "unique_ok": (F.col("distinct_keys") == F.col("row_count")).cast("int"),
        "non_empty_ok": (F.col("row_count") > 0).cast("int"),
        "required_ok": (null_total == 0).cast("int"),
    })


def enforce_gates(report: DataFrame, check_required: bool = False) -> dict:
    """Raise ``QualityGateError`` unless the uniqueness and non-empty gates pass (V2, V3);
    the required-column gate (V4) is optional, as the reference only documents it."""
    row = report.first().asDict()
    if row["unique_ok"] != 1:
        raise QualityGateError(f"duplicate keys: rows={row['row_count']} distinct={row['distinct_keys']}")
    if row["non_empty_ok"] != 1:
        raise QualityGateError("no rows survived")
    if check_required and row["required_ok"] != 1:
        raise QualityGateError(f"NULLs in required columns: {row}")
    return row


def assert_schema(df: DataFrame, contract: T.StructType, allow_extra: bool = False,
                  check_types: bool = True) -> None:
    """Compare a DataFrame schema to a contract by name."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in contract.fields}
    missing = [n for n in want if n not in have]
    extra = [n for n in have if n not in want]
    wrong = [n for n in want if n in have and check_types and have[n] != want[n]]
    if missing or wrong or (extra and not allow_extra):
        raise QualityGateError(f"schema mismatch: missing={missing} extra={extra} wrong_type={wrong}")


def column_profile(df: DataFrame, names=None) -> DataFrame:
    """One row per column: position, type, NULLs, least and greatest value (numbers only), from one aggregation."""
    fields = [df.schema[n] for n in names or df.columns]
    aggs = []
    for i, f in enumerate(fields):
        ends = [F.lit(None).cast("double")] * 2
        if isinstance(f.dataType, T.NumericType):
            ends = [F.min(f.name).cast("double"), F.max(f.name).cast("double")]
        aggs.append(F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                             F.lit(f.dataType.simpleString()).alias("type"), F.count_if(F.col(f.name).isNull()).alias("nulls"),
                             ends[0].alias("low"), ends[1].alias("high")))
    return df.agg(F.array(*aggs).alias("_rows")).select(F.inline("_rows"))


def schema_diff(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Schema check as data: one row per contract/actual column with its status."""
    spark = df.sparkSession
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in contract.fields}
    rows = []
    for i, n in enumerate(list(want) + [n for n in have if n not in want]):
        status = ("missing" if n not in have else "extra" if n not in want
                  else "ok" if have[n] == want[n] else "type_mismatch")
        rows.append((i, n, want.get(n), have.get(n), status))
    return spark.createDataFrame(rows, "position int, column_name string, expected_type string, "
                                       "actual_type string, status string")


# ---------------------------------------------------------------------------
# Scoring-record contract
# ---------------------------------------------------------------------------

def _col_or_null(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None)


def _number(c: Column) -> Column:
    """The finite number a value stands for, else NULL: a wrongly typed value is its row's error, not the job's."""
    n = c.try_cast("double")
    return F.when(F.isnan(n) | (F.abs(n) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(n)


def _is_flag(c: Column) -> Column:
    return F.coalesce(_number(c).isin(0.0, 1.0), F.lit(False))


def contract_errors(df: DataFrame,
                    ranges: dict = C.CONTRACT_RANGES,
                    required_flags: tuple = C.CONTRACT_REQUIRED_FLAGS,
                    defaulted_flags: tuple = C.CONTRACT_DEFAULTED_FLAGS) -> Column:
    """Array of violation messages per row (empty when the row is valid).

    Order: numeric fields (missing, then range), required flags (missing,
    then enum), defaulted flags (enum only, NULL means 0).
    """
    msgs = []
    for name, (lo, hi) in ranges.items():
        c = _col_or_null(df, name)
        n = _number(c)
        msgs.append(F.when(c.isNull(), F.lit(f"{name}: missing")))
        msgs.append(F.when(c.isNotNull() & n.isNull(), F.lit(f"{name}: not a number")))
        if name in C.CONTRACT_INTEGERS:
            msgs.append(F.when(n != F.floor(n), F.lit(f"{name}: not an integer")))
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (n < F.lit(lo))
        if hi is not None:
            bad = bad | (n > F.lit(hi))
        rng = f"[{lo}, {'inf' if hi is None else hi}]"
        msgs.append(F.when(n.isNotNull() & bad, F.lit(f"{name}: out of range {rng}")))
    for name in required_flags:
        c = _col_or_null(df, name)
        msgs.append(F.when(c.isNull(), F.lit(f"{name}: missing")))
        msgs.append(F.when(c.isNotNull() & ~_is_flag(c), F.lit(f"{name}: not in (0, 1)")))
    for name in defaulted_flags:
        c = _col_or_null(df, name)
        msgs.append(F.when(c.isNotNull() & ~_is_flag(c), F.lit(f"{name}: not in (0, 1)")))
    return F.filter(F.array(*msgs), lambda m: m.isNotNull())


def apply_contract(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Validate and normalise scoring records: ``_errors`` array, defaulted one-hot
    flags set to 0 (V8), typed contract columns; ``keep`` carries ids through."""
    errs = contract_errors(df)
    out = [F.col(k) for k in keep]
    for name in C.CONTRACT_RANGES:
        n = _number(_col_or_null(df, name))
        out.append((n.try_cast("int") if name in C.CONTRACT_INTEGERS else n).alias(name))
    for name in C.CONTRACT_REQUIRED_FLAGS:
        out.append(_number(_col_or_null(df, name)).try_cast("int").alias(name))
    for name in C.CONTRACT_DEFAULTED_FLAGS:
        out.append(F.coalesce(_number(_col_or_null(df, name)).try_cast("int"), F.lit(0)).alias(name))
    out.append(errs.alias("_errors"))
    return df.select(*out)


def output_contract_ok(prediction: str = "prediction", probability: str = "probability") -> Column:
    """Prediction in {0,1} and probability in [0,1]."""
    return (F.col(prediction).isin(0, 1) & F.col(probability).between(0.0, 1.0)).cast("int")
