"""SimHash near-dedup: anchor-point covering of the 64-bit fingerprints.

Fingerprint: words of the lower-cased text, shingles of ``words`` words (repeats
count), XXH64 of each; a bit is set if it is set in over half of the hashes.

Links: the anchors are the codewords of a covering code of the 64 bits, two
perfect Golay blocks [23, 12] (covering radius 3 each) and 18 bits in which every
anchor is zero.  A fingerprint's home is its nearest anchor.  If two fingerprints
differ in ``max_bits`` bits, each lies, block by block, within the covering radius
plus the bits that differ there from the other's home; so a fingerprint is
replicated to the anchors whose block distances exceed the radius by ``max_bits``
in sum at most (68 of 2^24 for two bits), and every linked pair meets at a home
anchor.  There XOR and a bit count decide exactly.

Distinct fingerprints only take part, so thousands of copies are one row.  The code
is linear: which anchors a block reaches depends on its syndrome alone (2048 rows,
computed from the generator polynomial).  A task reads its anchors in order and
keeps, of all links found, a spanning forest; an anchor with so many fingerprints
that comparing them pairwise would cost more looks up each one's neighbours within
``max_bits`` instead, which is linear.  The forests meet in ``connected_components``.

Defined cases: no words (null, empty, blank text) give fingerprint zero, linked like
any other; repeated rows and equal ids each get a row; a null id is ignored in the
minimum, so a component of null ids only has a null id; extra columns are ignored.
"""

from __future__ import annotations

import functools
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepared, raw_bytes, sliced, staged, text_hash
from .components import connected_components

SEED = 42
_POLYNOMIAL = 0b101011100011  # x^11+x^9+x^7+x^6+x^5+x+1 divides x^23+1: the perfect binary Golay code
_BLOCK, _RADIUS, _MASK = 23, 3, (1 << 23) - 1


# -- fingerprints ---------------------------------------------------------------

def fingerprint(text: bytes, words: int) -> int:
    tokens = text.lower().split()  # of bytes: A-Z, and white space \x20 \x09-\x0D
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    span = min(words, len(tokens))
    first = np.concatenate(([0], ends[:len(tokens) - span] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(first, ends[span - 1:].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at:at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprints(batches, words: int):
    for batch in sliced(batches, "text", 2 << 20):
        fps = np.array([fingerprint(t, words) for t in raw_bytes(batch.column(2))], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], names=["id", "h", "fp"])


# -- anchors --------------------------------------------------------------------

def _syndrome(word: np.ndarray) -> np.ndarray:
    """Remainder by the generator polynomial: 11 bits, zero for codewords."""
    word = word.copy()
    for bit in range(_BLOCK - 1, 10, -1):
        word ^= np.where(word >> bit & 1, _POLYNOMIAL << (bit - 11), 0).astype(word.dtype)
    return word


@functools.cache
def _golay(max_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By syndrome: the error to the home codeword; the other codewords reached (as differences from the
    home) with the bits that takes, as one list with offsets."""
    patterns = [sum(1 << b for b in c) for k in range(_RADIUS + 1) for c in combinations(range(_BLOCK), k)]
    patterns = np.array(patterns, np.int64)
    error = np.zeros(1 << 11, np.int64)
    error[_syndrome(patterns)] = patterns
    flips = [(k, sum(1 << b for b in c)) for k in range(max_bits + 1) for c in combinations(range(_BLOCK), k)]
    cost, flip = (np.array(x, np.int64) for x in zip(*flips))
    moved = _syndrome(flip)
    reach, bits, offsets = [], [], [0]
    for s in range(1 << 11):
        change = flip ^ error[s ^ moved] ^ error[s]  # the home after the flips, less the home before
        order = np.lexsort((cost, change))
        keep = order[np.concatenate(([True], np.diff(change[order]) != 0))]
        reach.append(change[keep])
        bits.append(cost[keep])
        offsets.append(offsets[-1] + len(keep))
    return error, np.concatenate(reach), np.concatenate(bits), np.array(offsets)


def _homes(word: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    error = _golay(max_bits)[0]
    syndrome = _syndrome(word)
    return word ^ error[syndrome], syndrome


def _expand(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers repeated by counts, and starts[row] + 0, 1, ..."""
    rows = np.repeat(np.arange(len(counts)), counts)
    inner = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    return rows, starts[rows] + inner


def replicas(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, is home) for every anchor a fingerprint is sent to."""
    _, reach, bits, offsets = _golay(max_bits)
    home1, s1 = _homes((fps & np.uint64(_MASK)).astype(np.int64), max_bits)
    home2, s2 = _homes((fps >> np.uint64(_BLOCK) & np.uint64(_MASK)).astype(np.int64), max_bits)
    row1, at1 = _expand(offsets[s1], offsets[s1 + 1] - offsets[s1])
    row2, at2 = _expand(offsets[s2][row1], (offsets[s2 + 1] - offsets[s2])[row1])
    ok = bits[at1][row2] + bits[at2] <= max_bits
    row2, at2 = row2[ok], at2[ok]
    rows, change1, change2 = row1[row2], reach[at1][row2], reach[at2]
    # a codeword is known by its upper 12 bits
    anchor = (home1[rows] ^ change1) >> 11 | (home2[rows] ^ change2) >> 11 << 12
    return rows, anchor, (change1 == 0) & (change2 == 0)


def _to_anchors(batches, max_bits: int):
    for batch in batches:
        for at in range(0, len(batch), 512):
            fps = batch.column(0).slice(at, 512).to_numpy(zero_copy_only=False)
            rows, anchor, home = replicas(fps.view(np.uint64), max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(anchor.astype(np.int32)), pa.array(fps[rows]), pa.array(home)],
                                             names=["anchor", "fp", "home"])


# -- comparison -----------------------------------------------------------------

def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node of each node's component among nodes 0..n-1."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        low = np.minimum(la, lb)
        new = label.copy()
        np.minimum.at(new, la, low)
        np.minimum.at(new, lb, low)
        while (new != (jumped := new[new])).any():
            new = jumped
        if (new == label).all():
            break
        label = new
    return label


def _close(fp: np.ndarray, home: np.ndarray, first: np.ndarray, count: np.ndarray, max_bits: int, block: int = 1 << 18):
    """Linked (home row, other row) pairs of the groups [first, first + count), in bounded blocks."""
    size = np.repeat(count, count)
    begin = np.repeat(first, count)
    at = np.flatnonzero(home & (size > 1))
    size, begin = size[at], begin[at]
    done = 0
    while done < len(at):
        upto = max(done + 1, int(np.searchsorted(np.cumsum(size[done:]), block)) + done)
        rows, other = _expand(begin[done:upto], size[done:upto])
        rows = at[done:upto][rows]
        near = np.bitwise_count(fp[rows] ^ fp[other]) <= max_bits
        near &= fp[rows] < fp[other]  # the pair is met at both homes
        yield rows[near], other[near]
        done = upto


def _neighbours(fp: np.ndarray, home: np.ndarray, max_bits: int):
    """The same for one large group: every word within max_bits of a home is looked up."""
    masks = np.array([sum(1 << b for b in c) for k in range(1, max_bits + 1) for c in combinations(range(64), k)], np.uint64)
    order = np.argsort(fp)
    sorted_ = fp[order]
    at = np.flatnonzero(home)
    step = max(1, (1 << 18) // len(masks))
    for k in range(0, len(at), step):
        rows = np.repeat(at[k:k + step], len(masks))
        near = (fp[at[k:k + step]][:, None] ^ masks).ravel()
        found = np.minimum(np.searchsorted(sorted_, near), len(sorted_) - 1)
        ok = (sorted_[found] == near) & (fp[rows] < near)
        yield rows[ok], order[found[ok]]


def _forest(anchor: np.ndarray, fp: np.ndarray, home: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (fingerprint, root fingerprint) of whole anchor groups, given in anchor order."""
    first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    count = np.diff(np.append(first, len(anchor)))
    lookups = sum(1 for k in range(1, max_bits + 1) for _ in combinations(range(64), k))
    large = count > 8 * lookups
    names, node = np.unique(fp, return_inverse=True)
    label = np.arange(len(names))
    pairs = [(_close, first[~large], count[~large])] if (~large).any() else []
    a_all, b_all, held = [], [], 0

    def fold() -> None:
        nonlocal label, held
        if held:
            label = roots(len(names), np.concatenate([*a_all, np.arange(len(names))]), np.concatenate([*b_all, label]))
            a_all.clear()
            b_all.clear()
            held = 0

    def take(found) -> None:
        nonlocal held
        for a, b in found:
            a_all.append(node[a])
            b_all.append(node[b])
            held += len(a)
            if held > 1 << 20:
                fold()

    if pairs:
        keep = np.repeat(~large, count)
        rows = np.flatnonzero(keep)
        small_first = np.cumsum(count[~large]) - count[~large]
        take((rows[a], rows[b]) for a, b in _close(fp[rows], home[rows], small_first, count[~large], max_bits))
    for f, c in zip(first[large], count[large]):
        take((a + f, b + f) for a, b in _neighbours(fp[f:f + c], home[f:f + c], max_bits))
    fold()
    moved = np.flatnonzero(label != np.arange(len(names)))
    return names[moved], names[label[moved]]


def _compare(batches, max_bits: int, least: int = 1 << 18):
    """Anchor groups arrive in order; whole groups are compared once enough rows are held."""
    anchor, fp, home = [], [], []
    hold = least

    def links(last: bool):
        a, f, h = np.concatenate(anchor), np.concatenate(fp), np.concatenate(home)
        cut = len(a) if last else int(np.searchsorted(a, a[-1]))
        anchor[:], fp[:], home[:] = [a[cut:]], [f[cut:]], [h[cut:]]
        x, y = _forest(a[:cut], f[:cut], h[:cut], max_bits) if cut else (np.zeros(0, np.uint64),) * 2
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], names=["a", "b"])

    for batch in batches:
        anchor.append(batch.column(0).to_numpy())
        fp.append(batch.column(1).to_numpy().view(np.uint64))
        home.append(batch.column(2).to_numpy(zero_copy_only=False))
        if sum(map(len, anchor)) > hold:
            yield links(False)
            hold = max(least, 2 * len(anchor[0]))
    if anchor:
        yield links(True)


def fingerprint_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Spanning links (a, b) between the distinct values of ``fp`` that differ in ``max_bits`` bits or fewer."""
    sent = fps.select("fp").distinct().mapInArrow(functools.partial(_to_anchors, max_bits=max_bits), "anchor int, fp long, home boolean")
    return (sent.repartition("anchor").sortWithinPartitions("anchor")
            .mapInArrow(functools.partial(_compare, max_bits=max_bits), "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """One row per input row: id, ``h`` (text hash), ``fp`` (long), ``component_id`` (smallest id reachable),
    ``root`` (the component's smallest fingerprint)."""
    prepared(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("h"), F.col(text_col).alias("text"))
    schema = T.StructType([narrow.schema["id"], T.StructField("h", T.LongType()), T.StructField("fp", T.LongType())])
    fps = staged(narrow.mapInArrow(functools.partial(_fingerprints, words=words), schema), "fingerprints")
    linked = connected_components(fingerprint_links(fps, max_bits))
    by_fp = fps.groupBy("fp").agg(F.min("id").alias("least"))
    by_fp = by_fp.join(linked, by_fp["fp"] == linked["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    by_fp = staged(by_fp, "fingerprint-roots")
    ids = by_fp.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = staged(by_fp.select("fp", "root").join(ids, "root"), "fingerprint-classes")
    out = fps.join(classes, "fp")
    return out.select(F.col("id").alias(id_col), "h", "fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each component: its smallest id (null ids last), then the smallest text hash."""
    found = near_duplicates(docs, id_col, text_col, words, max_bits)
    key = F.struct(F.col(id_col).isNull().alias("no"), F.col(id_col).alias("id"), "h")
    # the component's first row, and how many rows are the same (its copies under one id)
    rows = found.groupBy("root", id_col, "h").agg(F.count("*").alias("n"))
    kept = rows.groupBy("root").agg(F.min(F.struct(key.alias("k"), "n")).alias("first"))
    kept = staged(kept.select(F.col("first.k.id").alias("__sd_id"), F.col("first.k.h").alias("__sd_h"), F.col("first.n").alias("__sd_n")), "kept-documents")
    keyed = docs.withColumn("__sd_of", text_hash(text_col))
    same = keyed[id_col].eqNullSafe(F.col("__sd_id")) & (keyed["__sd_of"] == F.col("__sd_h"))
    # hash tables of the narrow side: the texts are shuffled but not sorted
    single = keyed.join(kept.filter("__sd_n = 1").hint("shuffle_hash"), same, "left_semi")
    repeated = keyed.join(kept.filter("__sd_n > 1"), same, "left_semi").dropDuplicates([id_col, "__sd_of"])
    return single.unionByName(repeated).select(*[f"`{c}`" for c in docs.columns])
