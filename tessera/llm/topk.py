"""Exact top-k search: inner products bounded by segment means and deviations, coarse to fine.

Cut two vectors into segments.  With a segment's means m, m' and deviations s, s' and
its length n, the squared distance there is at least n ((m - m')^2 + (s - s')^2), and so
the inner product at most n (m m' + s s').  Finer segments give tighter bounds.  A task
holds a block of queries and a block of candidates: it computes the coarsest bound for
all of them, the exact scores of the best few by it (a floor for the k-th score), then
drops what cannot reach the floor, level by level, and computes exact scores for
the survivors.

The grid: candidates and queries are dealt into blocks of bounded size and each
(candidate block, query block) cell is one group; a cell gives each query's k best, and
the k best of all cells are chosen per query.

Scaling: x -> floor(scale * x), as integers; scores are exact.

Defined cases: vectors that are null, or hold a null or a non-finite component, take no
part; neither do null ids, nor components that are no long after scaling (2^63).  Products
of large components are taken in Python integers; a result whose score is no long fails
the query.  Vectors of different lengths are not compared.  Repeated rows (same id, same vector) count
once; the query's own id is never a candidate.  Fewer than k candidates: all of them.
Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepared, staged

LEVELS = (4, 16)  # segments, coarse to fine
LONG = np.iinfo(np.int64)  # its least value stands for scores below it too


def _segments(x: np.ndarray, segments: int) -> np.ndarray:
    """Per vector: sqrt(n) * mean and sqrt(n) * deviation of every segment, side by side."""
    cuts = np.linspace(0, x.shape[1], min(segments, max(1, x.shape[1])) + 1).astype(int)
    out = []
    for a, b in zip(cuts, cuts[1:]):
        part = x[:, a:b]
        mean = part.mean(1)
        out += [np.sqrt(b - a) * mean, np.sqrt(np.square(part - mean[:, None]).sum(1))]
    return np.stack(out, 1)


def best_of_cell(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int, block: int = 1 << 19, part: int = 1 << 15):
    """(query row, candidate row, score) of each query's k best candidates, ties to the smaller id.  Integer matrices."""
    order = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[order], c[order]
    if not c.shape[1]:
        q, c = np.zeros((len(q), 1), np.int64), np.zeros((len(c), 1), np.int64)
    qf, cf = q.astype(np.float64), c.astype(np.float64)
    # room for rounding, in the bounds of each pair
    q_room, c_room = (np.sqrt(1e-9) * np.sqrt((x * x).sum(1)) for x in (qf, cf))
    q_levels = [np.column_stack((_segments(qf, s), q_room)) for s in LEVELS]
    c_levels = [np.column_stack((_segments(cf, s), c_room)) for s in LEVELS]
    q_most, c_most = np.abs(qf).max(1, initial=0), np.abs(cf).max(1, initial=0)
    whole = q_most.max(initial=0) * c_most.max(initial=0) * q.shape[1] < 2 ** 52  # doubles are exact

    def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if whole:
            return np.einsum("ij,ij->i", qf[a], cf[b]).astype(np.int64)
        out = (q[a] * c[b]).sum(1)
        for n in np.flatnonzero(q_most[a] * c_most[b] * q.shape[1] >= 2 ** 62):
            score = sum(x * y for x, y in zip(q[a[n]].tolist(), c[b[n]].tolist()))
            if score > LONG.max:  # the query's best then, at least
                raise OverflowError(f"the inner product of vectors {q_ids[a[n]]} and {c_ids[b[n]]} is no long: {score}")
            out[n] = max(score, LONG.min)
        return out

    step = max(1, block // max(1, len(c)))
    for at in range(0, len(q), step):
        rows = np.arange(at, min(at + step, len(q)))
        bound = q_levels[0][rows] @ c_levels[0].T
        own = q_ids[rows][:, None] == c_ids
        bound[own] = -np.inf
        few = min(k, len(c))
        top = np.argpartition(-bound, few - 1, axis=1)[:, :few]
        r, t = np.repeat(rows, few), top.ravel()
        other = ~np.isneginf(np.take_along_axis(bound, top, 1).ravel())
        scores = np.full(len(r), LONG.min)
        scores[other] = exact(r[other], t[other])
        floor = scores.reshape(-1, few).min(1).astype(np.float64)
        floor -= 0.5 + 1e-15 * np.abs(floor)
        floor[floor <= -9e18] = -np.inf  # fewer than k candidates so far
        i, j = np.nonzero((bound >= floor[:, None]) & ~own)
        for q_level, c_level in zip(q_levels[1:], c_levels[1:]):
            keep = np.concatenate([np.einsum("ij,ij->i", q_level[rows[i[x:x + part]]], c_level[j[x:x + part]]) >= floor[i[x:x + part]]
                                   for x in range(0, len(i), part)] or [np.zeros(0, bool)])
            i, j = i[keep], j[keep]
        scores = np.concatenate([exact(rows[i[x:x + part]], j[x:x + part]) for x in range(0, len(i), part)] or [np.zeros(0, np.int64)])
        best = np.lexsort((j, -scores, i))  # j grows with the id
        i, j, scores = i[best], j[best], scores[best]
        first = np.searchsorted(i, i)
        keep = np.arange(len(i)) - first < k
        yield rows[i[keep]], c_ids[j[keep]], scores[keep]


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def _cell(k: int):
    def cell(key, queries, candidates):
        ids, others, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(queries) and len(candidates):
            dim = key[0].as_py()
            q_ids = queries["vec_id"].to_numpy()
            for r, c, s in best_of_cell(q_ids, _matrix(queries["v"], dim), candidates["vec_id"].to_numpy(), _matrix(candidates["v"], dim), k):
                ids.append(q_ids[r])
                others.append(c)
                scores.append(s)
        return pa.table({n: pa.array(np.concatenate(x)) for n, x in (("query_id", ids), ("vec_id", others), ("score", scores))})

    return cell


def scaled(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, dim, v: integer components) of the vectors that take part."""
    v = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale))
    finite = F.forall(F.col(vector_col), lambda x: x.isNotNull() & (F.abs(x.cast("double")) * scale < float(1 << 63)))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).filter(finite)  # NaN exceeds every bound
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.size(vector_col).alias("dim"), v.cast("array<long>").alias("v"))
    return rows.dropDuplicates()


def search(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
           scale: int = 256, query_block: int = 2048, candidate_block: int = 16384) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of each query's k best other vectors.

    ``is_query``: a condition on the id column, named ``vec_id`` there.
    """
    prepared(vectors.sparkSession)
    rows = staged(scaled(vectors, id_col, vector_col, scale), "vectors")
    n, n_queries = rows.agg(F.count("*"), F.count_if(is_query)).first()
    c_blocks, q_blocks = 1 + n // candidate_block, 1 + n_queries // query_block

    def dealt(df: DataFrame, blocks: int, copies: int, own: str, other: str) -> DataFrame:
        """Own block by hash; a copy for every block of the other side."""
        own_block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias(own)
        return df.select("dim", own_block, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(other), "vec_id", "v")

    queries = dealt(rows.filter(is_query), q_blocks, c_blocks, "qb", "cb")
    candidates = dealt(rows, c_blocks, q_blocks, "cb", "qb")
    cell = ["dim", "qb", "cb"]
    found = (queries.groupBy(*cell).cogroup(candidates.groupBy(*cell))
             .applyInArrow(_cell(k), "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    lost = F.raise_error(F.concat(F.lit("a score below every long, of query "), F.col("query_id").cast("string")))
    score = F.when(F.col("score") == int(LONG.min), lost.cast("long")).otherwise(F.col("score"))
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score"))
