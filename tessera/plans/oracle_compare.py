"""Local stand-in for the driver's correctness gate: run a Spark query and its
DuckDB oracle SQL on the same Parquet tables and compare row count, column
names/types and an order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import math

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6) + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "date": "DATE",
                 "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT"}


def type_diff(spark_df, con, sql: str) -> dict:
    """Columns whose Spark type and DuckDB oracle type differ."""
    s = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
         for f in spark_df.schema.fields}
    rel = con.sql(sql)
    d = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.execute(sql)
    d_cols = [c[0] for c in rel.description]
    d_rows = rel.fetchall()
    s_hash, s_lines = _digest(s_cols, s_rows)
    d_hash, d_lines = _digest(d_cols, d_rows)
    out = {
        "rows_spark": len(s_rows), "rows_oracle": len(d_rows),
        "rows_match": len(s_rows) == len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "hash_match": s_hash == d_hash,
        "types_match": not type_diff(spark_df, con, sql),
    }
    if not out["hash_match"]:
        sd = sorted(set(s_lines) - set(d_lines))[:3]
        dd = sorted(set(d_lines) - set(s_lines))[:3]
        out["sample_diff"] = {"spark_only": sd, "oracle_only": dd,
                              "spark_cols": sorted(s_cols), "oracle_cols": sorted(d_cols)}
    return out
