"""Source divergence audit: how the word use of a language's sources differs, by a sparse merge per pair.

Each text's words (runs of letters and of characters beyond ASCII, A-Z lower-cased) are counted
by (lang, source, term).  A language keeps the terms that stand in ``min_docs`` of its documents
or more: V terms.  A group's share of a kept term with ``c`` occurrences among its N is, in integers,
``p = 1 + floor(scale * (c + prior) / (N + prior * V))``.

    counts   texts -> (lang, term): its documents, its count by source          (one shuffle)
    chunks   kept counts -> per group and range of terms: sorted term ids and counts
    pairs    (lang, range, two blocks of groups) -> for each pair of groups the sum of |p - q|

A pair task co-groups the chunks of two blocks of sources, and merges each unordered pair once: the shorter array gallops
through the longer one (binary search), which prices the terms of both; a term of one side alone is priced against the
other side's empty share; what neither holds is priced by number, with both empty shares.  A range has about
``range_terms`` terms, so a task's memory is bounded by ``2 * block`` such chunks whatever the vocabulary or the number of
sources; a group with a third of all rows has no more terms than others.

Defined cases: null text, lang and source are ''; repeated rows count each time, as occurrences and as
documents; a group without terms takes part with empty shares; a language without kept terms gives pairs of value 0 and no
terms; a language of one source has no pairs; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepared, sliced, staged
from .words import NO_LETTER, words_of


# -- counts ----------------------------------------------------------------------

def _count(batches):
    """(lang, source, text) rows to (lang, source, term, count, docs), summed within a batch."""
    for batch in sliced(batches, "text", 8 << 20):
        row, code, words = words_of(batch.column(2), NO_LETTER)
        if not len(row):
            continue
        groups: dict[tuple, int] = {}
        group = np.array([groups.setdefault(k, len(groups)) for k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())])
        in_row, times = np.unique(row * len(words) + code, return_counts=True)
        key = group[in_row // len(words)] * len(words) + in_row % len(words)
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        names = list(groups)
        of = (key[first] // len(words)).tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array([names[g][0] for g in of], pa.string()), pa.array([names[g][1] for g in of], pa.string()),
             words.take(pa.array(key[first] % len(words))).cast(pa.large_string()).cast(pa.string()),
             pa.array(np.add.reduceat(times[order], first)), pa.array(np.diff(np.append(first, len(key))))],
            names=["lang", "source", "term", "count", "docs"])


def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """(tid, lang, term, count, by_source: array of (source, count)) of the terms in ``min_docs`` documents of their lang."""
    rows = docs.mapInArrow(_count, "lang string, source string, term string, count long, docs long")
    by_group = rows.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    terms = by_group.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("count"),
                                                 F.collect_list(F.struct("source", "count")).alias("by_source"))
    return terms.filter(F.col("docs") >= min_docs).select(F.monotonically_increasing_id().alias("tid"), "lang", "term", "count", "by_source")


# -- shares ----------------------------------------------------------------------

def share(count, total, terms, prior: int, scale: int) -> Column:
    """``1 + floor(scale * (count + prior) / (total + prior * terms))`` in longs, for a scale of a power of 1000."""
    over, rest = total + F.lit(prior) * terms, count + F.lit(prior)
    out = F.lit(0).cast("long")
    left = scale
    while left > 1:
        out, rest, left = (out + _div(rest, over)) * 1000, (rest % over) * 1000, left // 1000
    return out + _div(rest, over) + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _shares(count: np.ndarray, total: int, terms: int, prior: int, scale: int) -> np.ndarray:
    """The same of an array."""
    over = total + prior * terms
    rest = count.astype(np.int64) + prior
    out = np.zeros(len(rest), np.int64)
    left = scale
    while left > 1:
        out, rest, left = (out + rest // over) * 1000, rest % over * 1000, left // 1000
    return out + rest // over + 1


# -- pairs -----------------------------------------------------------------------

def _merge(tids_a, pa_, none_a: int, tids_b, pb_, none_b: int) -> tuple[int, int]:
    """Sum of |p - q| over the terms of either side, and how many those are."""
    if len(tids_a) > len(tids_b):
        tids_a, pa_, none_a, tids_b, pb_, none_b = tids_b, pb_, none_b, tids_a, pa_, none_a
    at = np.searchsorted(tids_b, tids_a)
    at[at == len(tids_b)] = 0
    both = tids_b[at] == tids_a if len(tids_b) else np.zeros(len(tids_a), bool)
    alone = np.ones(len(tids_b), bool)
    alone[at[both]] = False
    value = np.abs(pa_[both] - pb_[at[both]]).sum() + np.abs(pa_[~both] - none_b).sum() + np.abs(pb_[alone] - none_a).sum()
    return int(value), len(tids_b) + int((~both).sum())


def _pair_task(prior: int, scale: int):
    """Chunks of two blocks of groups to a row for each unordered pair across them (or within, if they are one)."""
    def merge(key, chunks):
        low, high = key[2].as_py(), key[3].as_py()
        groups = []
        for group, block, n, v, entries in zip(*(chunks[c].to_pylist() for c in ("grp", "own", "n", "v")), chunks["entries"].combine_chunks()):
            entries = entries.values
            tids, counts = (entries.field(i).to_numpy() for i in (0, 1))
            none = int(_shares(np.zeros(1), n, v, prior, scale)[0]) if n + prior * v else 0
            groups.append((group, block, tids, _shares(counts, n, v, prior, scale) if len(tids) else counts, none))
        out = []
        for i, (a, block_a, *side_a) in enumerate(groups):
            for b, block_b, *side_b in groups[i + 1:] if low == high else groups:
                if low == high or (block_a == low and block_b == high):
                    out.append((*(x.as_py() for x in key[:1]), min(a, b), max(a, b), *_merge(*side_a, *side_b), abs(side_a[2] - side_b[2])))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 6, [pa.string(), *[pa.int64()] * 5])],
                                    names=["lang", "a", "b", "value", "either", "apart"])

    return merge


def divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = 30,
               prior: int = 5, scale: int = 1_000_000_000, top: int = 50, block: int = 16, range_terms: int = 1 << 16) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank: each group's distance from every other source of its lang, and
    the ``top`` terms that it uses more than its lang does."""
    prepared(docs.sparkSession)
    empty = F.lit("")
    texts = docs.select(*[F.coalesce(F.col(c), empty).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    kept = staged(kept_terms(texts, min_docs), "audit-terms")
    entries = kept.select("lang", "tid", "term", F.col("count").alias("in_lang"), F.explode("by_source").alias("e"))
    entries = entries.select("lang", F.col("e.source").alias("source"), "tid", "term", "in_lang", F.col("e.count").alias("count"))

    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("count").alias("n_lang"))
    totals = entries.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    of_lang = Window.partitionBy("lang")
    groups = staged(groups.select(
        "lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n", "v", "n_lang")],
        (F.row_number().over(of_lang.orderBy("source")) - 1).cast("long").alias("grp"), F.count("*").over(of_lang).alias("sources")), "audit-groups")

    # every group has a chunk in every range, so that a pair meets in each
    ranges = F.expr(f"v div {int(range_terms)} + 1")
    entry = F.struct("tid", "count")
    named = entries.select("lang", "source", "tid", "count").join(groups, ["lang", "source"])
    with_terms = named.select("lang", "grp", "n", "v", "sources", F.pmod(F.xxhash64("tid"), ranges).alias("rng"), entry.alias("entry"))
    without = groups.select("lang", "grp", "n", "v", "sources", F.explode(F.sequence(F.lit(0).cast("long"), ranges - 1)).alias("rng"),
                            F.lit(None).cast("struct<tid: bigint, count: bigint>").alias("entry"))
    chunks = with_terms.unionByName(without).groupBy("lang", "grp", "n", "v", "sources", "rng").agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    own = F.expr(f"grp div {int(block)}")
    dealt = chunks.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(sources - 1) div {int(block)}"))))
    dealt = dealt.select("lang", "rng", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "grp", "own", "n", "v", "entries")
    merged = dealt.groupBy("lang", "rng", "low", "high").applyInArrow(
        _pair_task(prior, scale), "lang string, a long, b long, value long, either long, apart long")
    sums = merged.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("either").alias("either"), F.max("apart").alias("apart"))
    both_ways = sums.select("lang", "value", "either", "apart", F.explode(F.array(F.struct(F.col("a").alias("me"), F.col("b").alias("it")),
                                                                                 F.struct(F.col("b").alias("me"), F.col("a").alias("it")))).alias("p"))
    me = groups.select("lang", F.col("grp").alias("me"), "source", "v")
    it = groups.select("lang", F.col("grp").alias("it"), F.col("source").alias("item"))
    pairs = both_ways.select("lang", "value", "either", "apart", "p.me", "p.it").join(me, ["lang", "me"]).join(it, ["lang", "it"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", (F.col("value") + (F.col("v") - F.col("either")) * F.col("apart")).alias("value"))

    more = entries.join(groups.select("lang", "source", "n", "v", "n_lang"), ["lang", "source"])
    over = share(F.col("count"), F.col("n"), F.col("v"), prior, scale) - share(F.col("in_lang"), F.col("n_lang"), F.col("v"), prior, scale)
    terms = more.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), over.alias("value")).filter("value > 0")

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).unionByName(terms.withColumn("rank", rank).filter(F.col("rank") <= top))
