"""Line dedup: overlapping three-line windows, hashed and counted globally.

Every run of three consecutive lines is hashed (128 bits).  A window that
occurs more than once keeps its first occurrence, in the order (doc id, text
hash, line), and every later occurrence covers its lines; the covered lines of a
document, merged over its windows, are removed.  The first copy of every line
text survives somewhere, because a covered line always has an equal line at an
earlier position.

Defined cases: lines end at ``\\n``.  A document of fewer lines than a window is
one window (its whole text).  Windows of blank lines only are never compared.
A null text has no lines and stays null; a document whose lines are all covered
becomes the empty text.  Rows are identified by (id, text hash): repeated rows
get the same answer, rows that share an id but not a text are told apart, a
null id sorts first.  Extra columns pass through; input columns named like an
output column are replaced.

Scale: one Python pass emits (window hash, id, line); the counting aggregates on
the map side, so a window found in a third of all documents reaches its reducer
as one row a task; the join that finds later occurrences is a plain equi-join
that adaptive execution may split.  Only removed positions (merged per document)
travel back to the texts.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import over, prepared, raw_bytes, sliced, staged, text_hash


def _window_hashes(text: bytes, window: int) -> list[tuple[int, bytes]]:
    lines = text.split(b"\n")
    blank = [not line.strip() for line in lines]
    size = min(window, len(lines))
    digest = xxhash.xxh3_128_digest
    head = b"%d\n" % size
    return [(i, digest(head + b"\n".join(lines[i:i + size])))
            for i in range(len(lines) - size + 1) if not all(blank[i:i + size])]


def _emit_windows(batches, window: int):
    for batch in sliced(batches, "text", 2 << 20):
        ids, hashes = batch.column(0), batch.column(1)
        rows, lines, digests = [], [], []
        for row, text in enumerate(raw_bytes(batch.column(2))):
            for line, digest in _window_hashes(text, window) if text else ():
                rows.append(row)
                lines.append(line)
                digests.append(digest)
        if rows:
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            take = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [ids.take(take), hashes.take(take), pa.array(lines, pa.int32()),
                 pa.array(np.ascontiguousarray(halves[:, 0])), pa.array(np.ascontiguousarray(halves[:, 1]))],
                names=["id", "h", "line", "w1", "w2"])


def repeated_windows(docs: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """Per document (id, h): the sorted first lines of its later-occurrence windows."""
    narrow = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("h"), F.col(text_col).alias("text"))
    schema = T.StructType([narrow.schema["id"], T.StructField("h", T.LongType()), T.StructField("line", T.IntegerType()),
                           T.StructField("w1", T.LongType()), T.StructField("w2", T.LongType())])
    windows = staged(narrow.mapInArrow(functools.partial(_emit_windows, window=window), schema), "line-windows")
    at = F.struct("id", "h", "line")
    firsts = (windows.groupBy("w1", "w2").agg(F.min(at).alias("first"), F.count("*").alias("n"))
              .filter("n > 1").drop("n"))
    return (windows.join(firsts, ["w1", "w2"]).filter(~at.eqNullSafe(F.col("first")))
            .groupBy("id", "h").agg(F.sort_array(F.collect_set("line")).alias("starts")))


def _merged(starts: list[int], size: int) -> list[list[int]]:
    """Covered spans [first, end), merged."""
    spans: list[list[int]] = []
    for s in starts:
        if spans and s <= spans[-1][1]:
            spans[-1][1] = s + size
        else:
            spans.append([s, s + size])
    return spans


def _cleaner(window: int):
    kind = pa.struct([("text", pa.string()), ("spans", pa.list_(pa.list_(pa.int32())))])

    @F.arrow_udf("struct<text:string,spans:array<array<int>>>")
    def clean(text: pa.Array, starts: pa.Array) -> pa.Array:
        out = []
        for t, s in zip(text.to_pylist(), starts.to_pylist()):
            if t is None or s is None:
                out.append(None)
                continue
            lines = t.split("\n")
            spans = _merged(s, min(window, len(lines)))
            kept, at = [], 0
            for first, end in spans:
                kept += lines[at:first]
                at = end
            out.append({"text": "\n".join(kept + lines[at:]), "spans": spans})
        return pa.array(out, kind)

    return clean


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 3) -> DataFrame:
    """``docs`` with covered lines removed from ``text_col``.

    Adds ``removed_spans`` (array of [first line, end line) in the input text)
    and ``n_lines`` (lines of the input text).
    """
    prepared(docs.sparkSession)
    found = repeated_windows(docs, id_col, text_col, window).select(
        F.col("id").alias("__ld_id"), F.col("h").alias("__ld_h"), F.col("starts").alias("__ld_starts"))
    keyed = docs.withColumn("__ld_h2", text_hash(text_col))
    # a hash table of the narrow side: the texts are shuffled but not sorted
    joined = keyed.join(found.hint("shuffle_hash"), (keyed[id_col].eqNullSafe(found["__ld_id"])) & (keyed["__ld_h2"] == found["__ld_h"]), "left")
    touched = F.when(F.col("__ld_starts").isNotNull(), F.col(text_col))
    joined = joined.withColumn("__ld_new", _cleaner(window)(touched, F.col("__ld_starts")))
    text = F.when(F.col("__ld_starts").isNull(), F.col(text_col)).otherwise(F.col("__ld_new.text"))
    n_lines = F.length(F.regexp_replace(text_col, "[^\n]", "")).cast("long") + 1
    out = over(joined, **{text_col: text, "removed_spans": F.coalesce(F.col("__ld_new.spans"), F.array().cast("array<array<int>>")),
                          "n_lines": F.coalesce(n_lines, F.lit(0).cast("long"))})
    order = [c for c in docs.columns if c.lower() not in ("removed_spans", "n_lines")] + ["removed_spans", "n_lines"]
    return out.select(*[f"`{c}`" for c in order])
