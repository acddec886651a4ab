"""LM scoring: a weighted backoff automaton over smoothed n-grams, one traversal a text.

Model (order two): unigrams smoothed by addition, ``pb(w) = (c(w) + a) / (N + a (V + 1))``,
and for the word u before w a Dirichlet prior around them,
``p(w | u) = (c(u w) + k pb(w)) / (c(u) + k)``.  As an automaton: a state for every
seen word and one for the text's begin; a seen pair u w is an arc of weight
``p(w | u)``; for any other word the failure arc of u, of weight ``k / (c(u) + k)``,
leads to the root, whose arcs carry ``pb``.  Probabilities of a state sum to one.

The automaton of a whole corpus fits in no task, and no task needs it: the texts are
cut into buckets of near ``bucket_bytes`` that are tokenised once and stored as word
numbers; each bucket asks for the corpus counts of the n-grams that it holds, and walks
its own part of the automaton, whose arc table is the bucket's sorted n-gram list.

    tokens   = texts -> bucket rows                       (stored once)
    asked    = bucket -> (part of the hash line, sorted n-gram hashes, own counts)
    answered = all that asked for a part -> summed counts, in the order they were asked
    scores   = bucket + its answers -> one walk over its texts

N-grams are known by 64-bit hashes; a bucket sends each of its n-grams once however
frequent it is, so the commonest pair of words is one row per bucket, and parts of the
hash line are of equal size by construction.

Defined cases: null text is empty; an empty text is its end token alone; a text without
training texts gets the smoothed unigram of an empty corpus; repeated rows are all
scored, and count each time in training; a null id is training text iff ``train``
says so.  Extra columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepared, raw_bytes, sliced, staged

END = b"\n"     # no word holds white space
BEGIN = b"\r"
ADD, PRIOR = 0.1, 300.0

_BUCKET = "bucket long, train_rows long, tokens long, lengths binary, train binary, words binary, ids binary"
_ASKED = "part int, bucket long, pairs binary, pair_counts binary, words binary, word_counts binary"
_ANSWERED = "part int, bucket long, pairs binary, words binary"


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words, white space being \\x20 and \\x09-\\x0D."""
    return text.lower().split()


def _plane(values: np.ndarray) -> bytes:
    """Integers as byte planes (all lowest bytes, then the next, ...), which Spark's codecs pack well."""
    return values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T.tobytes()


def _unplane(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _sorted_plane(keys: np.ndarray) -> bytes:
    """Sorted hashes by their differences."""
    return _plane(np.diff(keys, prepend=np.uint64(0)))


def _sorted_unplane(data: bytes) -> np.ndarray:
    return np.cumsum(_unplane(data, np.uint64), dtype=np.uint64)


def _to_buckets(batches, bucket_bytes: int):
    """(id, train, text) rows to bucket rows; ids stay beside the bucket as their own column."""
    part = TaskContext.get().partitionId()
    number = 0
    ids, train, lengths, numbers, vocabulary = [], [], [], [], {}
    held = 0

    def bucket():
        nonlocal number, held
        words = list(vocabulary)
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
        order = np.argsort(hashes, kind="stable")
        rank = np.empty(len(words), np.uint32)
        rank[order] = np.arange(len(words), dtype=np.uint32)
        flat = rank[np.concatenate(numbers)]
        row = [pa.array([(part << 32) + number], pa.int64()), pa.array([sum(train)], pa.int64()), pa.array([len(flat)], pa.int64()),
               pa.array([np.array(lengths, np.uint32).tobytes()], pa.binary()), pa.array([np.array(train, np.uint8).tobytes()], pa.binary()),
               pa.array([_sorted_plane(hashes[order])], pa.binary()), pa.array([_plane(flat)], pa.binary()),
               pa.ListArray.from_arrays([0, len(lengths)], pa.concat_arrays(ids))]
        number += 1
        for x in (ids, train, lengths, numbers):
            x.clear()
        vocabulary.clear()
        held = 0
        return pa.RecordBatch.from_arrays(row, names=["bucket", "train_rows", "tokens", "lengths", "train", "words", "ids", "doc_ids"])

    for batch in sliced(batches, "text", 1 << 21):
        ids.append(batch.column(0))
        train += [bool(x) for x in batch.column(1).to_pylist()]
        for text in raw_bytes(batch.column(2)):
            words = words_of(text)
            words.append(END)
            for w in words:
                if w not in vocabulary:
                    vocabulary[w] = len(vocabulary)
            numbers.append(np.fromiter(map(vocabulary.__getitem__, words), np.uint32, len(words)))
            lengths.append(len(words))
            held += len(text) + 1
        if held >= bucket_bytes:
            yield bucket()
    if lengths:
        yield bucket()


_BEGIN_HASH = np.uint64(xxhash.xxh3_64_intdigest(BEGIN))


def _mix(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    """A hash of a pair of word hashes."""
    x = u * np.uint64(0x9E3779B97F4A7C15) + w
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


class Bucket:
    """A bucket's texts as one run of word numbers, and its n-grams in hash order."""

    def __init__(self, lengths: bytes, train: bytes, words: bytes, ids: bytes) -> None:
        self.lengths = np.frombuffer(lengths, np.uint32).astype(np.int64)
        self.train = np.frombuffer(train, np.uint8).astype(bool)
        self.words = _sorted_unplane(words)
        self.ids = _unplane(ids, np.uint32).astype(np.int64)
        self.first = np.cumsum(self.lengths) - self.lengths
        begin = len(self.words)  # the state before a text's first word
        self.before = np.concatenate(([begin], self.ids[:-1]))
        self.before[self.first] = begin
        names = np.append(self.words, _BEGIN_HASH)
        self.pairs, self.arc = np.unique(_mix(names[self.before], self.words[self.ids]), return_inverse=True)

    def own_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Of the bucket's training texts: pairs, words."""
        weight = np.repeat(self.train, self.lengths)
        return (np.bincount(self.arc[weight], minlength=len(self.pairs)).astype(np.uint32),
                np.bincount(self.ids[weight], minlength=len(self.words)).astype(np.uint32))


def _cuts(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where sorted hashes cross into each of equal parts of the hash line."""
    edges = [(i << 64) // parts for i in range(1, parts)]
    return np.concatenate(([0], np.searchsorted(keys, np.array(edges, np.uint64)), [len(keys)]))


def _ask(batches, parts: int):
    for batch in batches:
        for r in batch.select(["bucket", "lengths", "train", "words", "ids"]).to_pylist():
            bucket = Bucket(r["lengths"], r["train"], r["words"], r["ids"])
            pair_counts, word_counts = bucket.own_counts()
            p, w = _cuts(bucket.pairs, parts), _cuts(bucket.words, parts)
            rows = [(i, r["bucket"], _sorted_plane(bucket.pairs[a:b]), _plane(pair_counts[a:b]),
                     _sorted_plane(bucket.words[c:d]), _plane(word_counts[c:d]))
                    for i, (a, b, c, d) in enumerate(zip(p, p[1:], w, w[1:])) if b > a or d > c]
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[2:])],
                names=["part", "bucket", "pairs", "pair_counts", "words", "word_counts"])


def _totals(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Summed counts in each list's own order; all sums."""
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.bincount(at, np.concatenate(counts), len(distinct)).astype(np.uint64)
    return np.split(sums[at], np.cumsum([len(k) for k in keys])[:-1]), sums


def _answer(key, table):
    rows = table.to_pylist()
    pairs, _ = _totals([_sorted_unplane(r["pairs"]) for r in rows], [_unplane(r["pair_counts"], np.uint32) for r in rows])
    words, sums = _totals([_sorted_unplane(r["words"]) for r in rows], [_unplane(r["word_counts"], np.uint32) for r in rows])
    return pa.table({
        "part": table["part"], "bucket": table["bucket"], "pairs": pa.array([_plane(x) for x in pairs], pa.binary()),
        "words": pa.array([_plane(x) for x in words], pa.binary()),
        # of the whole part, on its first row only: training tokens, distinct training tokens
        "n": pa.array([int(sums.sum())] + [0] * (len(rows) - 1), pa.int64()),
        "v": pa.array([int((sums > 0).sum())] + [0] * (len(rows) - 1), pa.int64())})


class Automaton:
    """The part of the backoff automaton that a bucket's texts can visit.

    States: the bucket's words, then the begin state.  ``arc[i]`` is the log weight of the bucket's i-th pair,
    ``fail`` a state's failure weight, ``root`` the root's arc to each word.
    """

    def __init__(self, pairs: np.ndarray, words: np.ndarray, begins: float, n: int, v: int) -> None:
        self.counts = words.astype(np.float64)
        self.pairs = pairs.astype(np.float64)
        self.state = np.append(self.counts, begins) + PRIOR
        self.root = np.log10((self.counts + ADD) / (n + ADD * (v + 1)))
        self.fail = np.log10(PRIOR / self.state)

    def walk(self, bucket: Bucket) -> np.ndarray:
        """Log weight of every step of one left-to-right walk.  An order-two state is the word just read, so the
        states along the walk are ``bucket.before`` and all steps are taken at once."""
        state, word, arc = bucket.before, bucket.ids, self.pairs[bucket.arc]
        fallen = self.fail[state] + self.root[word]
        seen = arc > 0
        fallen[seen] = np.log10((arc[seen] + PRIOR * 10 ** self.root[word[seen]]) / self.state[state[seen]])
        return fallen


def _score(n: int, v: int, begins: int):
    def score(key, buckets, answers):
        r = buckets.to_pylist()[0]
        bucket = Bucket(r["lengths"], r["train"], r["words"], r["ids"])
        order = np.argsort(answers["part"].to_numpy())
        parts = answers.select(["pairs", "words"]).to_pylist()
        pairs, words = (np.concatenate([_unplane(parts[i][c], np.uint64) for i in order]) for c in ("pairs", "words"))
        automaton = Automaton(pairs, words, begins, n, v)
        add = functools.partial(np.add.reduceat, indices=bucket.first)
        return pa.table({
            "id": buckets["doc_ids"].combine_chunks().flatten(), "train": pa.array(bucket.train),
            "n_tokens": pa.array(bucket.lengths), "n_known": pa.array(add((words > 0)[bucket.ids].astype(np.int64))),
            "train_tokens": pa.array(np.full(len(bucket.lengths), n, np.int64)),
            "base_score": pa.array(add(automaton.root[bucket.ids])), "score": pa.array(add(automaton.walk(bucket)))})

    return score


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
                bucket_bytes: int = 12 << 20, part_tokens: int = 4_000_000) -> DataFrame:
    """Per document: id, ``train``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` (log10).

    ``train``: condition for a row to teach the model.
    """
    prepared(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType
    schema = T._parse_datatype_string(_BUCKET).add("doc_ids", T.ArrayType(id_type))
    buckets = staged(rows.mapInArrow(functools.partial(_to_buckets, bucket_bytes=bucket_bytes), schema), "lm-buckets")
    tokens, begins = buckets.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("train_rows"), F.lit(0))).first()
    parts = 1 + tokens // part_tokens
    asked = buckets.mapInArrow(functools.partial(_ask, parts=parts), _ASKED)
    answered = staged(asked.groupBy("part").applyInArrow(_answer, _ANSWERED + ", n long, v long"), "lm-counts")
    n, v = answered.agg(F.sum("n"), F.sum("v")).first()
    schema = T.StructType([T.StructField("id", id_type)]).add("train", "boolean").add("n_tokens", "long").add("n_known", "long") \
        .add("train_tokens", "long").add("base_score", "double").add("score", "double")
    return (buckets.groupBy("bucket").cogroup(answered.drop("n", "v").groupBy("bucket"))
            .applyInArrow(_score(n or 0, v or 0, begins), schema).withColumnRenamed("id", id_col))

