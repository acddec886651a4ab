"""Words of whole text columns and hashes of their shingles, found with array operations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes between words: white space, or whatever is neither a letter nor beyond ASCII.
WHITE_SPACE = np.zeros(256, bool)
WHITE_SPACE[[0x20, *range(0x09, 0x0E)]] = True
NO_LETTER = np.zeros(256, bool)
NO_LETTER[[*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def spans_of(column: pa.Array | pa.ChunkedArray, between: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A text column's bytes, which of them are in words, where its rows begin, and first byte and end of every word (null has none)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    inside = ~between[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    filled = offsets[1:] > offsets[:-1]  # a word never spans two rows
    begin[offsets[:-1][filled]] = inside[offsets[:-1][filled]]
    end[offsets[1:][filled] - 1] = inside[offsets[1:][filled] - 1]
    return data, inside, offsets, np.flatnonzero(begin), np.flatnonzero(end) + 1


def coded(words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Words given as their bytes, one after the other, and their lengths: the code of each, the words by code."""
    ends = np.concatenate(([0], np.cumsum(lengths)))
    every = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(words)]).dictionary_encode()
    return every.indices.to_numpy().astype(np.int64), every.dictionary


def listed(words: pa.LargeBinaryArray) -> list[bytes]:
    """The same as ``to_pylist`` of words without nulls, several times faster."""
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int64, len(words) + 1, words.offset * 8).tolist() if len(words) else [0]
    data = data.to_pybytes() if data else b""
    return [data[a:b] for a, b in zip(ends, ends[1:])]


def words_of(column: pa.Array | pa.ChunkedArray, between: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of every row of a text column (A-Z lower-cased; null has none), in order: row, code, the words by code."""
    data, inside, offsets, first, end = spans_of(column, between)
    code, words = coded(LOWER[data[inside]], end - first)
    return np.searchsorted(offsets, first, "right") - 1, code, words


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def shingles_of(column: pa.Array, width: int, between: np.ndarray = WHITE_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``width`` words of every row (fewer words: the whole sequence), as (row, 64-bit hash), sorted by hash."""
    row, code, words = words_of(column, between)
    known = np.fromiter(map(xxhash.xxh64_intdigest, listed(words)), np.uint64, len(words))
    word = known[code]
    n = np.bincount(row, minlength=len(column))
    begin = np.cumsum(n) - n
    rows, hashes = [], []
    for size in range(1, width + 1):  # a row's shingles are all of one size
        at = np.flatnonzero(np.minimum(n, width)[row] == size) if size < width else np.flatnonzero(np.arange(len(row)) + width <= (begin + n)[row])
        if size < width:
            at = at[at == begin[row[at]]]
        h = np.full(len(at), size, np.uint64)
        for k in range(size):
            h = h * np.uint64(0x9E3779B97F4A7C15) + word[at + k]
        rows.append(row[at])
        hashes.append(_mixed(h))
    rows, hashes = np.concatenate(rows), np.concatenate(hashes)
    order = np.argsort(hashes, kind="stable")
    rows, hashes = rows[order], hashes[order]  # by hash; the rows of one size are in order already
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


# -- arrays in binary columns ------------------------------------------------------

def planes(values: np.ndarray) -> bytes:
    """Unsigned integers as byte planes (all lowest bytes, then the next, ...) up to the highest byte in use."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 0
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unplanes(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    if n:
        out[:, :len(data) // n] = np.frombuffer(data, np.uint8).reshape(-1, n).T
    return out.view("<u8").ravel()


def deltas(values: np.ndarray) -> bytes:
    """Sorted unsigned integers by their differences."""
    return planes(np.diff(values, prepend=values.dtype.type(0)))


def undeltas(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unplanes(data, n), dtype=np.uint64)


def expand(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers repeated by counts, and starts[row] + 0, 1, ..."""
    rows = np.repeat(np.arange(len(counts)), counts)
    return rows, np.repeat(starts, counts) + np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
