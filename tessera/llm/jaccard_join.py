r"""N-gram Jaccard join: size-banded tiles, bitmap bounds, then exact sorted-array intersection.

A document's set: the distinct shingles of ``width`` words (lower-cased A-Z, white space
\x20 \x09-\x0D; fewer words: the whole sequence as one).  Two documents link if
``100 * |x & y| >= percent * |x | y|``.

    ask      texts -> blocks of distinct shingle hashes, cut by parts of the hash line
    answer   part -> the hashes that two sets or more hold, with their number, back to the block
    sketch   block -> per set: size, bitmap and sorted array of its shared hashes, its rare prefix
    tile     sets that hold a token in their prefix, by token, size band and pair of blocks, with their bitmaps
             -> the sets of each tile that have a partner there by their bitmaps, with the best one
    link     these pairs, by intersecting the two sorted arrays -> components
    rest     tiles that still hold several components, with arrays -> the links across them, likewise

Exactness: shingles have one order in all sets (rare ones first).  Linked sets x and y have
``o >= percent/100 * max(|x|, |y|)`` shingles in common, so their first common one lies among the
first ``|x| - ceil(percent/100 |x|) + 1`` of x, and of y likewise: they meet at that token.  A
shingle that no other set holds needs no tile, so most documents send nothing, and what
thousands of documents share stands last in the order.  Tokens held by the same sets
make one tile.  A tile takes the sets of one size band and those at the top of the band below (a
linked pair's sizes are in one band or in adjacent ones); a token of more than ``tile_rows`` sets is
dealt into blocks, with a tile for each pair of blocks, so a tile's rows are bounded.

In a tile, a set's bitmap has a bit for each hash of its shared shingles; a bit of x that y lacks
is a shingle of x that y lacks, which bounds ``o`` from above.  Few sets have a partner by that bound.  As links are wanted for
connectivity, each set's best pair in a tile is intersected first, once for all tiles that name it, which
connects most copies.  Only sets of tiles that still hold several components send their arrays there; a wider
bitmap sifts the pairs across components once more, and what passes is intersected exactly, until what remains
is connected or not linked.  A task gives a spanning forest of its links, never pairs by the square.
``similar_pairs`` passes no pair over.

Shingles are known by 64-bit hashes within a set and by 56 bits of them across sets.

Defined cases: null, empty and blank texts have the empty set, size 0, and link with nothing, not
even each other; equal texts are one class; a repeated row is a row of its own; a null id
counts as no smallest id; extra columns are ignored.

Scale: texts are read twice (digests; shingles) and never shuffled.  About seven bytes a
shingle go to their part, once per task for a text that many rows repeat.  A part holds near
``part_bytes`` of text's shingles.  Blocks and parts grow with the tasks' memory by parameter; at
100 TB take parts of 1 GB.  Rows must come in the same order if a task is run again, as they do
from files.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepared, sliced, staged
from .components import connected_components
from .simhash import roots
from .words import deltas, expand, planes, shingles_of, undeltas, unplanes

#: Bits of a shingle's hash that leave its block.
BITS = 56
_ASKED = "part long, block long, n int, hashes binary, owners binary, counts binary"
_SKETCH = "digest binary, n int, held int, shared binary, prefix binary, bits binary"
#: A bitmap that is sent has a bit for each shingle of the set or up to twice as many, 64 at least, and this many at most (beyond,
#: its bound is weaker); one that is built beside the array has ``BITS_A_SHINGLE`` times as many.
MOST_BITS, BITS_A_SHINGLE = 1 << 14, 8
#: A size band ends at this many times its first size.
BAND = 4


# -- ask and answer --------------------------------------------------------------

def _asked(part: list[int], block: int, n: list[int], *columns: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int64()), pa.array([block] * len(part), pa.int64()), pa.array(n, pa.int32()), *[pa.array(c, pa.binary()) for c in columns]],
        names=["part", "block", "n", "hashes", "owners", "counts"])


def _block_rows(block: int, digests: list[bytes], sizes: list[np.ndarray], rows: list[np.ndarray], hashes: list[np.ndarray], parts: int):
    """The questions of a block of sets, and a row (own negative part) that lists its sets."""
    row, h = np.concatenate(rows), np.concatenate(hashes) >> np.uint64(64 - BITS)
    order = np.argsort(h, kind="stable")
    row, h = row[order], h[order]
    edges = np.searchsorted(h, np.array([(p << BITS) // parts for p in range(parts + 1)], np.uint64))
    edges[-1] = len(h)
    some = np.flatnonzero(np.diff(edges))
    first, last = edges[some].tolist(), edges[some + 1].tolist()
    part, n = some.tolist(), [b - a for a, b in zip(first, last)]
    listed = np.concatenate(sizes).astype(np.uint64)
    return _asked([*part, -1 - block], block, [*n, len(listed)],
                  [*[deltas(h[a:b]) for a, b in zip(first, last)], b"".join(digests)],
                  [*[planes(row[a:b]) for a, b in zip(first, last)], planes(listed)], [None] * (len(n) + 1))


def _ask(batches, width: int, parts: int, block_shingles: int, remembered: int = 1 << 20):
    """(digest, text) rows to questions; a text that this task has sent is not sent again."""
    block, sent = TaskContext.get().partitionId() << 24, set()
    digests, sizes, rows, hashes, held, docs = [], [], [], [], 0, 0
    for batch in sliced(batches, "text", 512 << 10):
        keys = batch.column(0).to_pylist()
        if len(sent) > remembered:
            sent = set()
        new = [not (k in sent or sent.add(k)) for k in keys]
        batch = batch.filter(pa.array(new))
        row, h = shingles_of(batch.column(1), width)
        n = np.bincount(row, minlength=len(batch))
        digests += batch.column(0).to_pylist()
        sizes.append(n)
        rows.append(row + docs)
        hashes.append(h)
        held, docs = held + len(h), docs + len(batch)
        if held > block_shingles:
            yield _block_rows(block, digests, sizes, rows, hashes, parts)
            block, digests, sizes, rows, hashes, held, docs = block + 1, [], [], [], [], 0, 0
    if docs:
        yield _block_rows(block, digests, sizes, rows, hashes, parts)


def _answer(key, asked):
    """For each block that asked, its hashes that occur in several sets; a list of sets passes as it is."""
    if key[0].as_py() < 0:
        return asked
    n, blocks = asked["n"].to_pylist(), asked["block"].to_pylist()
    each = [undeltas(h, k) for h, k in zip(asked["hashes"].to_pylist(), n)]
    owners = asked["owners"].to_pylist()
    every = np.sort(np.concatenate(each))
    first = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
    counts = np.diff(np.append(first, len(every)))
    shared, counts = every[first[counts > 1]], counts[counts > 1]
    out = []
    for block, h, owner in zip(blocks, each, owners):
        at = np.searchsorted(shared, h)
        at[at == len(shared)] = 0
        hit = np.flatnonzero(shared[at] == h) if len(shared) else np.zeros(0, np.int64)
        if len(hit):
            out.append(_asked([key[0].as_py()], block, [len(hit)], [deltas(h[hit])], [planes(unplanes(owner, len(h))[hit])], [planes(counts[at[hit]])]))
    return pa.Table.from_batches(out, asked.schema)


# -- sketches --------------------------------------------------------------------

def _width(bits: int) -> int:
    return max(64, 1 << (bits - 1).bit_length())


def _bitmap(hashes: np.ndarray, width: int) -> np.ndarray:
    bits = np.zeros(width, np.uint8)
    bits[(hashes & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def _sketch(percent: int):
    return lambda key, answers: _sketch_rows(answers, percent)


def _sketch_rows(answers: pa.Table, percent: int) -> pa.Table:
    """One row per set of the block: size, and if it may have a link its shared hashes (sorted, by differences) and rare prefix."""
    digests, sizes, owners, hashes, counts = b"", np.zeros(0, np.uint64), [], [], []
    for part, n, h, o, c in zip(*(answers[x].to_pylist() for x in ("part", "n", "hashes", "owners", "counts"))):
        if part < 0:
            digests, sizes = h, unplanes(o, n).astype(np.int64)
        else:
            hashes.append(undeltas(h, n))
            owners.append(unplanes(o, n).astype(np.int64))
            counts.append(unplanes(c, n))
    owner, h, count = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (owners, hashes, counts))
    owner = owner.astype(np.int64)
    held = np.bincount(owner, minlength=len(sizes))
    wanted = sizes - (percent * sizes + 99) // 100 + 1 - (sizes - held)  # what the rare prefix holds beside unshared shingles
    by_hash = np.lexsort((h, owner))
    by_rank = np.lexsort((h, count, owner))
    first = np.cumsum(held) - held
    shared, prefix, bits = [], [], []
    for n, w, a, k in zip(sizes.tolist(), wanted.tolist(), first.tolist(), held.tolist()):
        alive = n > 0 and k > 0 and w > 0
        own = h[by_hash[a:a + k]] if alive else None
        shared.append(deltas(own) if alive else None)
        bits.append(_bitmap(own, min(MOST_BITS, _width(n))).tobytes() if alive else None)
        prefix.append(h[by_rank[a:a + min(w, k)]].tobytes() if alive else None)
    return pa.table({"digest": pa.array([digests[16 * i:16 * i + 16] for i in range(len(sizes))], pa.binary()), "n": pa.array(sizes.astype(np.int32)),
                     "held": pa.array(held.astype(np.int32)), "shared": pa.array(shared, pa.binary()), "prefix": pa.array(prefix, pa.binary()),
                     "bits": pa.array(bits, pa.binary())})


def sketches(texts: DataFrame, width: int, percent: int, part_bytes: int, block_shingles: int) -> DataFrame:
    """(digest, text) rows to one row per text and task that read it, see ``_sketch_rows``."""
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    asked = texts.mapInArrow(functools.partial(_ask, width=width, parts=1 + total // part_bytes, block_shingles=block_shingles), _ASKED)
    answers = asked.groupBy("part").applyInArrow(_answer, _ASKED)
    return answers.groupBy("block").applyInArrow(_sketch(percent), _SKETCH)


# -- tiles -----------------------------------------------------------------------

def _tokens(batches):
    for batch in batches:
        if not len(batch):
            continue
        each = [np.frombuffer(p, np.int64) for p in batch.column(1).to_pylist()]
        rows = pa.array(np.repeat(np.arange(len(batch)), [len(e) for e in each]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(each)), batch.column(0).take(rows)], names=["token", "cid"])


def _edges(percent: int) -> np.ndarray:
    """First sizes of the bands, wide enough for a linked pair's sizes to lie in one band or in adjacent ones."""
    edges = [1]
    while edges[-1] < 1 << 32:
        edges.append(max(edges[-1] * 100 // percent + 1, BAND * edges[-1]))
    return np.array(edges)


#: What a row does in its tile: stands for the smaller set of a pair, for the larger, or for either.
SMALLER, LARGER, EITHER = 0, 1, 2


def _deal(batches, percent: int, tile_rows: int):
    """(cid, n, held, bits, tokens, rows of each token) to the tiles that the set takes part in.

    The larger set of a pair stands in its own band and in row ``own`` of the token's block square, the smaller one in its
    own band, and in the next if a set of that may link to it, in column ``own``.
    """
    edges, mix = _edges(percent), -7046029254386353131
    for batch in batches:
        cid, n = (batch.column(i).to_numpy() for i in (0, 1))
        tokens, counts = batch.column(4), batch.column(5)
        of = np.repeat(np.arange(len(batch)), np.diff(tokens.offsets.to_numpy()))
        token, count = tokens.flatten().to_numpy(), counts.flatten().to_numpy()
        band = np.searchsorted(edges, n, "right")
        blocks = -(-count // tile_rows)
        own = (cid[of] * mix >> 33) % blocks
        row, other = expand(np.zeros(len(of), np.int64), blocks)
        aside = other != own[row]
        reaches = (n * 100 // percent >= edges[np.minimum(band, len(edges) - 1)])[of[row]]
        parts = [(row, 0, own[row], other, np.where(aside, LARGER, EITHER)), (row[aside], 0, other[aside], own[row[aside]], np.full(aside.sum(), SMALLER)),
                 (row[reaches], 1, other[reaches], own[row[reaches]], np.full(reaches.sum(), SMALLER))]
        tile = np.concatenate([(((token[r] * mix + band[of[r]] + up) * mix + i) * mix + j) * mix for r, up, i, j, _ in parts])
        take = of[np.concatenate([p[0] for p in parts])]
        role = np.concatenate([p[4] for p in parts]).astype(np.int32)
        for at in range(0, len(take), 4096):
            some = pa.array(take[at:at + 4096])
            yield pa.RecordBatch.from_arrays([pa.array(tile[at:at + 4096]), *[batch.column(i).take(some) for i in range(4)], pa.array(role[at:at + 4096])],
                                             names=["tile", "cid", "n", "held", "bits", "role"])


def _folded(bits: np.ndarray) -> np.ndarray:
    return bits[:len(bits) // 2] | bits[len(bits) // 2:]


class _Bitmaps:
    """Bitmaps of some sets, each compared at the narrower width of a pair; a wider one is folded in half."""

    def __init__(self, bitmaps: list[np.ndarray]) -> None:
        self.width = np.array([64 * len(b) for b in bitmaps], np.int64)
        self.at, self.maps = {}, {}
        for w in np.unique(self.width).tolist():
            same, wide = np.flatnonzero(self.width == w), np.flatnonzero(self.width == 2 * w)
            at = np.full(len(bitmaps), -1)
            at[np.concatenate((same, wide))] = np.arange(len(same) + len(wide))
            self.at[w] = at
            self.maps[w] = np.array([bitmaps[i] for i in same.tolist()] + [_folded(bitmaps[i]) for i in wide.tolist()])

    def lacking(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many bits of each pair's first set its second lacks, and the other way round."""
        out = np.zeros((2, len(a)), np.int64)
        narrow = np.minimum(self.width[a], self.width[b])
        for w in np.unique(narrow).tolist():
            mine = np.flatnonzero(narrow == w)
            step = max(1, (1 << 23) // w)
            for m in (mine[k:k + step] for k in range(0, len(mine), step)):
                x, y = (self.maps[w][self.at[w][rows[m]]] for rows in (a, b))
                both = x & y
                shared = np.bitwise_count(both).sum(1, dtype=np.int64)
                out[0, m], out[1, m] = np.bitwise_count(x).sum(1, dtype=np.int64) - shared, np.bitwise_count(y).sum(1, dtype=np.int64) - shared
        return out[0], out[1]


def _passing(tile: np.ndarray, n: np.ndarray, held: np.ndarray, bitmaps: list[np.ndarray], larger: np.ndarray, percent: int, wanted,
             block: int = 1 << 17):
    """(larger row, earlier row, bound of what they share) of whole tiles (rows sorted by tile, n, cid) whose bitmaps allow a link."""
    bitmaps = _Bitmaps(bitmaps)
    at = np.flatnonzero(larger)
    least = (n[at] * percent + 99) // 100  # a linked set has this many shingles
    top = int(n.max()) + 2
    low = np.maximum(np.searchsorted(tile, tile[at]), np.searchsorted(tile * top + n, tile[at] * top + least))
    count = np.maximum(at - low, 0)
    ends = np.cumsum(count)
    done = 0
    while done < len(at):
        upto = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + block, "right")))
        row, other = expand(low[done:upto], count[done:upto])
        row = at[done:upto][row]
        ok = wanted(row, other)
        row, other = row[ok], other[ok]
        lack_row, lack_other = bitmaps.lacking(row, other)
        bound = np.minimum(held[row] - lack_row, held[other] - lack_other)
        keep = (100 + percent) * bound >= percent * (n[row] + n[other])
        yield row[keep], other[keep], bound[keep]
        done = upto


def _common(arrays: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sorted arrays."""
    return np.array([len(np.intersect1d(arrays[i], arrays[j], assume_unique=True)) for i, j in zip(a.tolist(), b.tolist())], np.int64)


def _partners(tile, cid, n, held, role, bitmaps, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of whole tiles that have a partner by their bitmaps, and the best partner of each among smaller sets (-1: none)."""
    alive, best = np.zeros(len(cid), bool), np.full(len(cid), -1)
    for a, b, bound in _passing(tile, n, held, bitmaps, role != SMALLER, percent, lambda a, b: (cid[a] != cid[b]) & (role[b] != LARGER)):
        alive[a] = alive[b] = True
        order = np.lexsort((cid[b], -bound, a))
        a, b = a[order], b[order]
        first = np.ones(len(a), bool)
        first[1:] = a[1:] != a[:-1]
        best[a[first]] = cid[b[first]]
    rows = np.flatnonzero(alive)
    return rows, best[rows]


def _tile_links(tile, cid, n, role, component, arrays, percent: int, every: bool):
    """(cid, cid, common) of the links of whole tiles: all, or enough to connect the components that they connect."""
    node = np.unique(component, return_inverse=True)[1]
    label = np.arange(len(cid))
    bitmaps = [_bitmap(x, _width(BITS_A_SHINGLE * k)) for x, k in zip(arrays, n.tolist())]

    def wanted(a, b):
        return (cid[a] != cid[b]) & (role[b] != LARGER) & (every | (label[node[a]] != label[node[b]]))

    held = np.array([len(x) for x in arrays])
    for a, b, bound in _passing(tile, n, held, bitmaps, role != SMALLER, percent, wanted):
        order = np.lexsort((-bound, a))
        a, b = a[order], b[order]
        while len(a):
            now = np.ones(len(a), bool) if every else np.concatenate(([True], a[1:] != a[:-1]))
            x, y = a[now], b[now]
            common = _common(arrays, x, y)
            ok = 100 * common >= percent * (n[x] + n[y] - common)
            x, y = x[ok], y[ok]
            if len(x):
                yield cid[x], cid[y], common[ok]
                label = roots(len(label), np.concatenate((node[x], np.arange(len(label)))), np.concatenate((node[y], label)))
            a, b = a[~now], b[~now]
            apart = label[node[a]] != label[node[b]]
            a, b = a[apart], b[apart]


def _whole_tiles(batches, least_bytes: int = 16 << 20):
    """Batches in order of their tiles to tables of whole tiles, with the tiles' numbers."""
    held, size, hold = [], 0, least_bytes

    def cut(last: bool):
        nonlocal held, size, hold
        table = pa.Table.from_batches(held)
        tile = table["tile"].to_numpy()
        changes = np.flatnonzero(tile[1:] != tile[:-1]) + 1
        end = len(tile) if last else int(changes[-1]) if len(changes) else 0
        held = table.slice(end).combine_chunks().to_batches() if end < len(tile) else []
        size = sum(b.nbytes for b in held)
        hold = max(least_bytes, 2 * size)
        return table.slice(0, end), np.cumsum(np.concatenate(([False], tile[1:end] != tile[:end - 1]))) if end else tile[:0]

    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size > hold:
            table, tile = cut(False)
            if len(tile):
                yield table, tile
    if size:
        yield cut(True)


def _numbers(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table[c].to_numpy().astype(np.int64) for c in names]


def _survivors(batches, percent: int):
    for table, tile in _whole_tiles(batches):
        cid, n, held, role = _numbers(table, "cid", "n", "held", "role")
        rows, best = _partners(tile, cid, n, held, role, [np.frombuffer(b, np.uint64) for b in table["bits"].to_pylist()], percent)
        kept = table.select(["tile", "cid", "role"]).take(pa.array(rows))
        yield from kept.append_column("best", pa.array(best, mask=best < 0)).to_batches()


def _links_of(batches, percent: int, every: bool):
    for table, tile in _whole_tiles(batches):
        cid, n, role, component = _numbers(table, "cid", "n", "role", "component")
        arrays = [undeltas(x, k) for x, k in zip(table["shared"].to_pylist(), table["held"].to_pylist())]
        for a, b, common in _tile_links(tile, cid, n, role, component, arrays, percent, every):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(common)], names=["a", "b", "common"])


def _exact(batches, percent: int):
    """(a, b, n, held and array of both) to the linked pairs, with the size of their intersection."""
    for batch in batches:
        na, nb = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 3))
        common = np.array([len(np.intersect1d(undeltas(x, i), undeltas(y, j), assume_unique=True))
                           for i, j, x, y in zip(*(batch.column(k).to_pylist() for k in (4, 5, 6, 7)))], np.int64)
        ok = pa.array(100 * common >= percent * (na + nb - common))
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], names=["a", "b"])


def _tiles(classes: DataFrame, members: DataFrame, percent: int, tile_rows: int) -> DataFrame:
    """(tile, cid, role, best) of the sets that have a partner in a tile by their bitmaps."""
    tokens = members.groupBy("cid").agg(F.collect_list(F.struct("token", "rows")).alias("t"))
    rows = classes.join(tokens, "cid").select("cid", F.col("n").cast("long").alias("n"), "held", "bits", "t.token", "t.rows")
    tiles = rows.mapInArrow(functools.partial(_deal, percent=percent, tile_rows=tile_rows), "tile long, cid long, n long, held int, bits binary, role int")
    found = (tiles.repartition("tile").sortWithinPartitions("tile", "n", "cid")
             .mapInArrow(functools.partial(_survivors, percent=percent), "tile long, cid long, role int, best long"))
    return staged(found, "jaccard-tiles")


def _best_links(classes: DataFrame, tiles: DataFrame, percent: int) -> DataFrame:
    """The linked ones (a, b) among the best pairs of all tiles."""
    pairs = tiles.filter("best IS NOT NULL").select(F.least("cid", "best").alias("a"), F.greatest("cid", "best").alias("b")).distinct()
    x, y = (classes.select(F.col("cid").alias(k), F.col("n").alias(f"n{k}"), F.col("held").alias(f"h{k}"), F.col("shared").alias(f"s{k}")) for k in "ab")
    wide = pairs.join(x, "a").join(y, "b").select("a", "b", "na", "nb", "ha", "hb", "sa", "sb")
    return staged(wide.mapInArrow(functools.partial(_exact, percent=percent), "a long, b long"), "jaccard-best")


def _tile_rows_links(classes: DataFrame, tiles: DataFrame, percent: int, every: bool) -> DataFrame:
    """Linked pairs (a, b, common) of (tile, cid, role, component) rows: all, or enough to connect the components that they connect."""
    rows = tiles.select("tile", "cid", "role", "component").join(classes.select("cid", "n", "held", "shared"), "cid")
    links = (rows.repartition("tile").sortWithinPartitions("tile", "n", "cid")
             .mapInArrow(functools.partial(_links_of, percent=percent, every=every), "a long, b long, common long"))
    return staged(links.distinct(), "jaccard-links")


def _components(classes: DataFrame, tiles: DataFrame, percent: int) -> DataFrame:
    """(node, root) of the sets that have a link."""
    links = _best_links(classes, tiles, percent)
    found = connected_components(links)
    named = tiles.join(found, tiles["cid"] == found["node"], "left").select("tile", "cid", "role", F.coalesce("root", "cid").alias("component"))
    several = named.groupBy("tile").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    rest = staged(named.join(several, "tile", "left_semi"), "jaccard-rest")
    if rest.isEmpty():
        return found
    more = _tile_rows_links(classes, rest, percent, every=False).select("a", "b")
    return connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))


def _classes(docs: DataFrame, text_col: str, width: int, percent: int, part_bytes: int, block_shingles: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(all sets: digest, n), (sets that may have links: cid, digest, n, held, shared), (their tokens: token, cid, rows)."""
    if not 0 < percent <= 100:
        raise ValueError("percent must be above 0 and at most 100")
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.unhex(F.md5(text.cast("binary"))).alias("digest"), text.alias("text"))
    found = staged(sketches(texts, width, percent, part_bytes, block_shingles), "jaccard-sets")
    sets = found.groupBy("digest").agg(F.max("n").alias("n"))
    alive = found.filter("prefix is not null").dropDuplicates(["digest"])
    alive = staged(alive.select(F.monotonically_increasing_id().alias("cid"), "*"), "jaccard-classes")
    tokens = staged(alive.select("cid", "prefix").mapInArrow(_tokens, "token long, cid long"), "jaccard-tokens")
    # tokens that the same sets hold make one tile
    mixed = F.xxhash64("cid"), F.xxhash64(F.lit(1), "cid")
    kept = tokens.groupBy("token").agg(F.count("*").alias("rows"), *[F.bit_xor(m).alias(f"m{i}") for i, m in enumerate(mixed)]).filter("rows > 1")
    kept = kept.groupBy("rows", "m0", "m1").agg(F.min("token").alias("token")).select("token", "rows")
    members = staged(tokens.join(kept, "token").select("token", "cid", "rows"), "jaccard-members")
    return sets, alive, members


def similar_pairs(docs: DataFrame, text_col: str = "text", width: int = 5, percent: int = 80, part_bytes: int = 16 << 20,
                  block_shingles: int = 1 << 20, tile_rows: int = 2048) -> DataFrame:
    """Every linked pair of unequal texts: digest_a, digest_b (MD5 of the texts), common, n_a, n_b."""
    prepared(docs.sparkSession)
    _, alive, members = _classes(docs, text_col, width, percent, part_bytes, block_shingles)
    tiles = _tiles(alive, members, percent, tile_rows).withColumn("component", F.col("cid"))
    links = _tile_rows_links(alive, tiles, percent, every=True)
    a = alive.select(F.col("cid").alias("a"), F.col("digest").alias("digest_a"), F.col("n").alias("n_a"))
    b = alive.select(F.col("cid").alias("b"), F.col("digest").alias("digest_b"), F.col("n").alias("n_b"))
    return links.join(a, "a").join(b, "b").select("digest_a", "digest_b", "common", "n_a", "n_b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80,
                    part_bytes: int = 16 << 20, block_shingles: int = 1 << 20, tile_rows: int = 2048) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id`` (smallest id reachable by links, itself included)."""
    prepared(docs.sparkSession)
    sets, alive, members = _classes(docs, text_col, width, percent, part_bytes, block_shingles)
    found = _components(alive, _tiles(alive, members, percent, tile_rows), percent)
    named = alive.select("cid", "digest").join(found, F.col("cid") == F.col("node"), "left").select("digest", F.coalesce("root", "cid").alias("root"))
    rows = docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))).alias("digest"))
    info = sets.join(rows.groupBy("digest").agg(F.min("id").alias("least")), "digest").join(named, "digest", "left")
    info = staged(info.select("digest", "n", "least", "root"), "jaccard-texts")
    of_root = info.filter("root is not null").groupBy("root").agg(F.min("least").alias("component"))
    of_text = info.join(of_root, "root", "left").select("digest", "n", F.coalesce("component", "least").alias("component"))
    out = rows.join(staged(of_text, "jaccard-components"), "digest")
    return out.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"))
