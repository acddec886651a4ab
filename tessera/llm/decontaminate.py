"""Benchmark decontamination: documents streamed through a generalised suffix automaton.

The automaton holds every run of words of every benchmark item.  A document's words
are fed to it one by one; it keeps the longest run ending here that occurs in some
item.  A run of ``window`` words or more marks the last ``window`` words as hit; so does a
whole item of fewer words.  A state knows the items its run occurs in.  Words that no
item has are looked up first, all at once: between them only stretches as long as the
shortest window are walked.

Words: lower-cased (A-Z) runs of ASCII letters, digits and any non-ASCII characters.

``clean`` drops documents whose hit share exceeds ``max_coverage``, or that have more
than ``max_hit_words`` hit words (no limit by default), and cuts the hit spans out of
the others, each replaced by a line end, again and again until nothing is hit.

Defined cases: null and empty texts, and texts without words, have no words and are
clean; null, empty and repeated items: an item without words has no window, every
item id with the window is named, a null item id is not named but still hits;
repeated documents get equal answers; an empty benchmark hits nothing.  Extra columns
pass through; input columns named like an output column are replaced.

Scale: the items are normalised in Spark, dealt into blocks of ``block_words`` words,
and the blocks broadcast, so a task holds one block's automaton and every document
meets all blocks in one map task with no shuffle of texts.  An item longer than a
block is cut into overlapping pieces, so a block's size is bounded whatever the items.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import over, prepared, raw_bytes, sliced

_WORD = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
_TABLE = bytes(c if c in _WORD else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_SPAN = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, with the windows that hit.

    ``items``: (name, words, is whole item) triples; a piece that is not a whole item has ``window`` words at least.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes], bool]], window: int) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        owners: list[set] = [set()]
        short: list[set | None] = [None]  # items that are exactly this state's longest run
        ends = []
        for name, words, whole in items:
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            last = 0
            for n in numbers:
                last = self._extend(last, n)
            ends.append((name, numbers, whole and 0 < len(numbers) < window))
        states = len(self.next)
        owners += [set() for _ in range(states - 1)]
        short += [None] * (states - 1)
        self.shortest = min((min(len(n), window) for _, n, _ in ends if n), default=window)
        for name, numbers, is_short in ends:
            state = 0
            for n in numbers:  # all states whose runs end here in this item: this one and its links
                state = self.next[state][n]
                up = state
                while up > 0 and name not in owners[up]:
                    owners[up].add(name)
                    up = self.link[up]
            if is_short:
                short[state] = (short[state] or set()) | {name}
        # the state on the link path whose runs include the one of ``window`` words, and the short items on the path
        self.items = [frozenset()] * states
        self.at_window = [0] * states
        self.shorts: list[tuple] = [()] * states
        for s in sorted(range(1, states), key=self.length.__getitem__):
            up = self.link[s]
            self.at_window[s] = self.at_window[up] or (s if self.length[s] >= window else 0)
            own = ((self.length[s], frozenset(short[s])),) if short[s] else ()
            self.shorts[s] = self.shorts[up] + own
            if self.at_window[s] == s:
                self.items[s] = frozenset(owners[s])

    def _extend(self, last: int, n: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if n in nxt[last]:
            q = nxt[last][n]
            return q if length[q] == length[last] + 1 else self._clone(last, n, q)
        state = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and n not in nxt[p]:
            nxt[p][n] = state
            p = link[p]
        if p >= 0:
            q = nxt[p][n]
            link[state] = q if length[q] == length[p] + 1 else self._clone(p, n, q)
        return state

    def _clone(self, p: int, n: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p >= 0 and nxt[p].get(n) == q:
            nxt[p][n] = copy
            p = link[p]
        return copy

    def scan(self, words: list[bytes], hit: np.ndarray, names: set) -> None:
        """Mark the hit words and add the names of the items with occurring windows."""
        numbers = np.fromiter(map(self.vocabulary.get, words, [0] * len(words)), np.int64, len(words))
        edge = np.flatnonzero(np.diff(np.concatenate(([0], numbers > 0, [0]))))
        for first, end in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if end - first >= self.shortest:
                self._walk(numbers[first:end].tolist(), first, hit, names)

    def _walk(self, numbers: list[int], first: int, hit: np.ndarray, names: set) -> None:
        nxt, link, lengths, window = self.next, self.link, self.length, self.window
        at_window, shorts, shortest = self.at_window, self.shorts, self.shortest
        state = length = 0
        for i, n in enumerate(numbers, first + 1):
            while state and n not in nxt[state]:
                state = link[state]
                length = lengths[state]
            if n in nxt[state]:
                state = nxt[state][n]
                length += 1
            if length >= shortest:
                if length >= window:
                    hit[i - window:i] = True
                    names |= self.items[at_window[state]]
                for size, found in shorts[state]:
                    if size <= length:
                        hit[i - size:i] = True
                        names |= found


def _pieces(name: str | None, words: list[bytes], window: int, block: int):
    """A whole item, or a too long one's overlapping pieces."""
    if len(words) <= block:
        return [(name, words, True)]
    return [(name, words[i:i + block], False) for i in range(0, len(words) - window + 1, block - window + 1)]


def benchmark_blocks(items: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> list:
    """Broadcast blocks of the benchmark, each of ``block_words`` words or near; read through one at a time."""
    spark = items.sparkSession
    blocks, block, held = [], [], 0
    rows = items.select(F.col(id_col).cast("string"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8"))
    for name, text in rows.toLocalIterator():
        for piece in _pieces(name, words_of(bytes(text)), window, block_words):
            if piece[1]:
                block.append(piece)
                held += len(piece[1])
                if held >= block_words:
                    blocks.append(spark.sparkContext.broadcast(block))
                    block, held = [], 0
    if block:
        blocks.append(spark.sparkContext.broadcast(block))
    return blocks


def _scanner(blocks: list, window: int):
    """words -> (hit flags, item names), over all blocks, two blocks' automata in memory at most."""
    built = functools.lru_cache(maxsize=2)(lambda k: SuffixAutomaton(blocks[k].value, window))

    def scan_all(documents: list[list[bytes]]) -> list[tuple[np.ndarray, set]]:
        found = [(np.zeros(len(words), bool), set()) for words in documents]
        for k in range(len(blocks)):
            automaton = built(k)
            for words, (hit, names) in zip(documents, found):
                if words:
                    automaton.scan(words, hit, names)
        return found

    return scan_all


_SCANNERS: dict = {}


def _scanner_of(blocks: list, window: int):
    """One scanner a worker process and broadcast, so that batches share the automaton."""
    key = (tuple(map(id, blocks)), window)
    if key not in _SCANNERS:
        _SCANNERS.clear()
        _SCANNERS[key] = _scanner(blocks, window)
    return _SCANNERS[key]


def _slices(text: pa.Array, most_bytes: int = 1 << 20):
    """The texts as bytes, so many at a time that their words fit beside each other in a task."""
    batch = pa.RecordBatch.from_arrays([text], names=["text"])
    return (raw_bytes(part.column(0)) for part in sliced([batch], "text", most_bytes))


def _spans(hit: np.ndarray) -> list[list[int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return edge.reshape(-1, 2).tolist()


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = 10,
               block_words: int = 40_000) -> DataFrame:
    """``docs`` plus ``n_words``, ``n_hit`` (long), ``hit_spans`` (array of [first, end) words) and ``items`` (sorted ids)."""
    prepared(docs.sparkSession)
    blocks = benchmark_blocks(items, id_col, text_col, window, block_words)

    @F.arrow_udf("struct<n_words:bigint,n_hit:bigint,hit_spans:array<array<int>>,items:array<string>>")
    def leaks(text: pa.Array) -> pa.Array:
        scan, out = _scanner_of(blocks, window), []
        for texts in _slices(text):
            for hit, names in scan([words_of(t) for t in texts]):
                out.append({"n_words": len(hit), "n_hit": int(hit.sum()), "hit_spans": _spans(hit),
                            "items": sorted(n for n in names if n is not None)})
        return pa.array(out, pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("hit_spans", pa.list_(pa.list_(pa.int32()))),
                                        ("items", pa.list_(pa.string()))]))

    found = docs.withColumn("__dc", leaks(F.col("`text`")))
    names = ("n_words", "n_hit", "hit_spans", "items")
    return over(found, **{n: F.col("__dc")[n] for n in names}).drop("__dc")


def _cut(text: bytes, hit: np.ndarray) -> bytes:
    """The text without its hit words and what stands between them; a line end for each span."""
    spans = [m.span() for m in _SPAN.finditer(text)]
    out, at = [], 0
    for first, end in _spans(hit):
        out += [text[at:spans[first][0]].rstrip(), b"\n"]
        at = spans[end - 1][1]
        rest = text[at:at + 1]
        if rest and rest in b".,;:!?)":  # what closed the span
            at += 1
        while text[at:at + 1] in (b" ", b"\n"):
            at += 1
    return b"".join(out + [text[at:]]).strip(b"\n")


def clean(docs: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = 10,
          block_words: int = 40_000, max_coverage: float = 0.5, max_hit_words: int | None = None) -> DataFrame:
    """``docs`` without its leaks: spans cut, documents beyond the limits dropped."""
    prepared(docs.sparkSession)
    blocks = benchmark_blocks(items, id_col, text_col, window, block_words)

    @F.arrow_udf("struct<keep:boolean,text:string>")
    def cleaned(text: pa.Array) -> pa.Array:
        scan, out = _scanner_of(blocks, window), []
        for texts in _slices(text):
            words = [words_of(t) for t in texts]
            for t, w, (hit, _) in zip(texts, words, scan(words)):
                n = int(hit.sum())
                keep = n <= max_coverage * len(w) and (max_hit_words is None or n <= max_hit_words)
                changed = keep and n > 0
                while keep and hit.any():
                    t = _cut(t, hit)
                    hit = scan([words_of(t)])[0][0]
                out.append({"keep": keep, "text": t.decode() if changed else None})
        return pa.array(out, pa.struct([("keep", pa.bool_()), ("text", pa.string())]))

    # declared nondeterministic so that the filter and the new text share one pass
    found = docs.withColumn("__dc", cleaned.asNondeterministic()(F.col("`text`"))).filter("__dc.keep")
    return found.withColumn("text", F.coalesce("__dc.text", "`text`")).select(*[f"`{c}`" for c in docs.columns])
