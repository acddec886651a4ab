"""Landing CSV files -> Bronze rows.

Bronze keeps every value as text (no type inference, no drift), captures
malformed lines whole in ``_corrupt_record``, derives ``_rescued_data`` from
surplus tokens, and stamps each row with ``_ingest_ts`` / ``_source_file``.
The same reader options serve the batch reader and the file-stream source.
"""

from __future__ import annotations

import csv
import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from .tables import path_exists

UNKNOWN_LAYOUT = "landing file without a noted header"
CORRUPT = "_corrupt_record"
RESCUED = "_rescued_data"


def raw_schema(columns=C.RAW_COLUMNS, corrupt: str | None = CORRUPT) -> T.StructType:
    """All-text schema of the landing files; the corrupt-record column must be
    declared in it or Spark drops malformed lines silently (S2, S4, X15)."""
    fields = [T.StructField(c, T.StringType(), True) for c in columns]
    if corrupt:
        fields.append(T.StructField(corrupt, T.StringType(), True))
    return T.StructType(fields)


def csv_options(header: bool = True, sep: str = ",", corrupt: str = CORRUPT) -> dict:
    return {
        "header": str(header).lower(),
        "sep": sep,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": corrupt,
        "inferSchema": "false",
        "enforceSchema": "true",
    }


def _tokens(line: Column, sep: str) -> Column:
    """Tokens of one CSV line; a quoted token may hold separators and loses its quotes."""
    q = re.escape(sep)
    tokens = F.regexp_extract_all(line, F.lit(rf'(?<=^|{q})("(?:[^"\\]|\\.|"")*"(?={q}|$)|[^{q}]*)'), 1)
    return F.transform(tokens, lambda t: F.when(
        t.rlike('^".*"$'), F.regexp_replace(F.regexp_replace(t, '^"|"$', ""), '""|\\"', '"')).otherwise(t))


def rescued_data(n_columns: int, sep: str = ",", corrupt: str | Column = CORRUPT) -> Column:
    """``_rescued_data`` as JSON ``{"_c<i>": token}`` of the tokens beyond the declared
    columns, NULL when there are none (S5); a separator inside quotes separates nothing."""
    toks = _tokens(F.col(corrupt) if isinstance(corrupt, str) else corrupt, sep)
    surplus = F.slice(toks, n_columns + 1, F.greatest(F.size(toks) - n_columns, F.lit(1)))
    entries = F.transform(surplus, lambda v, i: F.struct(
        F.concat(F.lit("_c"), (i + n_columns).cast("string")).alias("k"), v.alias("v")))
    return F.when(F.size(toks) > n_columns, F.to_json(F.map_from_entries(entries)))


def with_audit(df: DataFrame, n_columns: int = len(C.RAW_COLUMNS), sep: str = ",") -> DataFrame:
    """Add ``_rescued_data``, ``_ingest_ts`` (one value per batch) and ``_source_file``."""
    return df.select(
        *[F.col(c) for c in df.columns],
        rescued_data(n_columns, sep).alias(RESCUED),
        F.current_timestamp().alias("_ingest_ts"),
        F.col("_metadata.file_path").alias("_source_file"),
    )


def read_landing(spark: SparkSession, path, schema: T.StructType | None = None,
                 header: bool = True, sep: str = ",") -> DataFrame:
    """Batch read of landing CSV files into Bronze rows."""
    schema = schema or raw_schema()
    n = len([f for f in schema.fields if f.name != CORRUPT])
    df = spark.read.schema(schema).options(**csv_options(header, sep)).csv(path)
    return with_audit(df, n, sep)


def landing_manifest(spark: SparkSession, path: str) -> DataFrame:
    """List landing files (path, size, modification time) without reading them."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
                 .select("path", "length", "modificationTime"))


def write_landing(lines: DataFrame, path: str, header: str | None = None, files: int | None = None) -> str:
    """Write one CSV line per row of column ``line`` into ``path`` (fixture and
    replay helper).  Each file starts with ``header`` when given; the lines
    are written verbatim, so malformed lines stay malformed."""
    col = header if header is not None else "line"
    out = lines.select(F.col("line").alias(col))
    if files:
        out = out.repartition(files)
    (out.write.mode("errorifexists")
        .option("header", str(header is not None).lower())
        .option("sep", "\t").option("quote", "\u0000").option("escape", "\u0000")
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
        .csv(path))
    return path


def to_csv_line(cols, sep: str = ",") -> Column:
    """Join text columns into one CSV line; NULL becomes an empty field."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c), F.lit("")) for c in cols])


# ---------------------------------------------------------------------------
# Header layouts: columns bind by name, file by file (S3)
# ---------------------------------------------------------------------------

def file_headers(spark: SparkSession, paths) -> DataFrame:
    """Header line of every CSV file under ``paths`` (file_path, header): the first line
    that is not blank.  Read by Spark's own text source, so every filesystem of the
    cluster works alike; the cost is a scan of the first split of each given file."""
    txt = (spark.read.option("recursiveFileLookup", "true").text(paths)
                .select("value", F.col("_metadata.file_path").alias("file_path"),
                        F.col("_metadata.file_block_start").alias("block_start"),
                        F.monotonically_increasing_id().alias("at"))
                .filter((F.col("block_start") == 0) & (F.trim("value") != "")))
    return txt.groupBy("file_path").agg(F.min_by("value", "at").alias("header"))


def header_names(header: str, sep: str = ",") -> tuple[str, ...]:
    """Column names of a header line: quotes, a byte order mark and outer blanks go, an
    empty name becomes ``_c<i>``, a repeated one gets its position as a suffix."""
    names: list[str] = []
    for i, name in enumerate(next(csv.reader([header.lstrip("\ufeff")], delimiter=sep))):
        name = name.strip() or f"_c{i}"
        names.append(f"{name}_{i}" if name.lower() in [n.lower() for n in names] else name)
    return tuple(names)


def table_columns(headers, known=C.RAW_COLUMNS, sep: str = ",") -> tuple[str, ...]:
    """``known`` columns, then the other names of the headers in sorted header order.
    Names that differ in case only are one column."""
    columns = list(known)
    for header in sorted(headers):
        for name in header_names(header, sep):
            if name.lower() not in [c.lower() for c in columns]:
                columns.append(name)
    return tuple(columns)


def _binder(at: dict, columns, sep: str):
    """Positional struct of one layout -> struct of ``columns``; ``at`` gives the position of a lower-case name."""
    def bind(p: Column) -> Column:
        bound = [(p[f"_c{at[c.lower()]}"] if c.lower() in at else F.lit(None).cast("string")).alias(c) for c in columns]
        return F.struct(*bound, p[CORRUPT].alias(CORRUPT), rescued_data(len(at), sep, p[CORRUPT]).alias(RESCUED))

    return bind


def parse_by_layout(lines: DataFrame, headers, columns, sep: str = ",") -> DataFrame:
    """Lines (``value``, ``header``, ``_source_file``) -> Bronze rows.

    Each line is parsed once, with the layout of its own file, and its tokens bind to
    ``columns`` by header name; a column that the file lacks is NULL.  Lines equal to
    the header and blank lines are no rows.  A line of a file whose header is unknown
    (it landed after the headers were read) stops the job rather than being lost.
    """
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    row = F.raise_error(F.concat(F.lit(UNKNOWN_LAYOUT + ": "), F.col("_source_file")))
    fields = ", ".join(f"`{c}`: string" for c in (*columns, CORRUPT, RESCUED))
    row = row.cast(f"struct<{fields}>")
    for header in sorted(headers, reverse=True):
        at = {name.lower(): i for i, name in enumerate(header_names(header, sep))}
        schema = ", ".join([f"_c{i} string" for i in range(len(at))] + [f"{CORRUPT} string"])

        # the lambda's argument is parsed once, however many columns are taken from it
        parsed = F.transform(F.array(F.from_csv("value", schema, options)), _binder(at, columns, sep))[0]
        row = F.when(F.col("header") == header, parsed).otherwise(row)
    body = lines.filter((F.trim("value") != "") & ~F.col("value").eqNullSafe(F.col("header")))
    return (body.select(row.alias("_row"), "_source_file")
                .select("_row.*", F.current_timestamp().alias("_ingest_ts"), "_source_file"))


def with_headers(lines: DataFrame, heads: DataFrame) -> DataFrame:
    lines = lines.select("value", F.col("_metadata.file_path").alias("_source_file"))
    return lines.join(heads, lines["_source_file"] == heads["file_path"], "left").drop("file_path")


def read_evolving(spark: SparkSession, path, sep: str = ",", known=C.RAW_COLUMNS) -> DataFrame:
    """Batch read of landing files whose headers differ (S3); only the distinct headers reach the driver."""
    heads = file_headers(spark, path)
    headers = [r.header for r in heads.select("header").distinct().collect()]
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return parse_by_layout(with_headers(lines, heads), headers, table_columns(headers, known, sep), sep)


def track_layouts(spark: SparkSession, path: str, location: str) -> list[str]:
    """Note the header of every landing file not noted yet in the table at ``location``
    (file_path, header); returns the distinct headers of all.  Only new files are opened;
    their paths pass the driver, as in any file listing of Spark."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
                  .select(F.col("_metadata.file_path").alias("file_path")))
    seen = path_exists(spark, location)
    if seen:
        files = files.join(spark.read.parquet(location), "file_path", "left_anti")
    new = [unquote(r.file_path) for r in files.collect()]
    if new:
        file_headers(spark, new).write.mode("append").parquet(location)
    if not new and not seen:
        return []
    return [r.header for r in spark.read.parquet(location).select("header").distinct().collect()]
