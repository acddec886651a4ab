"""Packing: first-fit decreasing with a tournament tree, in randomised groups of documents.

Documents become token ids and one end id, cut at multiples of the sequence length;
the pieces are packed into sequences, largest first, each into the first sequence
with room.  The tree's leaves are the room left in each sequence and every inner
node the larger of its two, so the first fit is one walk from the root.

Groups are drawn by a hash of the document (id and text), of the task that reads it and of the number of its
copies the task has read before, about ``group_bytes`` of text each, and packed on their own.  So a row that is
repeated a million times is spread over the groups, and a task that is run again deals alike in whatever order its rows come.

Defined cases: a null or empty text is its end id alone; a text of exactly the
sequence length has a piece of one id after it; ties in length go by id, text hash,
start; repeated rows are each packed; extra columns are ignored.  Special-token strings
inside a text are encoded as the tokenizer does by default.

Scale: texts are tokenised where they are read and only pieces are shuffled (with ids
on request), once, into groups of bounded size; no group depends on another.
"""

from __future__ import annotations

import functools
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepared, sliced, text_hash
from .words import coded, expand, listed, spans_of

END_ID = 1
#: Bytes between chunks.
_BETWEEN = np.zeros(256, bool)
_BETWEEN[list(b" \t\n")] = True


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Remembered:
    """A bounded memory of two generations: what is not asked for while a generation fills is forgotten with it."""

    def __init__(self, most: int) -> None:
        self.half, self.young, self.old = max(1, most // 2), {}, {}

    def missing(self, wanted: set) -> list:
        """The keys that are not known; all others are in ``young`` now."""
        absent = wanted.difference(self.young)
        if len(self.young) + len(absent) > self.half:
            self.young, self.old, absent = {}, self.young, wanted
        young, old, new = self.young, self.old, []
        for k in absent:
            if k in old:
                young[k] = old[k]
            else:
                new.append(k)
        return new


def _classes() -> np.ndarray:
    """Of each character of the basic plane: 0 space, 1 letter, 2 number, 3 other, 4 to be looked at by the tokenizer itself."""
    import unicodedata

    kinds = {"L": 1, "N": 2}
    table = np.array([kinds.get(unicodedata.category(chr(c))[0], 3) for c in range(1 << 16)], np.uint8)
    table[[c for c in range(1 << 16) if chr(c).isspace()]] = 4
    table[ord(" ")], table[ord("'")], table[0xD800:0xE000] = 0, 4, 4
    return table


def _byte_characters() -> np.ndarray:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is printable, else the next one from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out = np.arange(256, dtype="<u4")
    for n, b in enumerate(b for b in range(256) if b not in plain):
        out[b] = 256 + n
    out[0x20] = 0x20  # stays between words
    return out


class ChunkEncoder:
    """Token ids of texts by a tokenizer that drops white space and lets no token span it.

    Then a text's ids are the ids of its chunks between spaces, tabs and line ends.  A chunk is cut before its closing
    punctuation, and letters are put into lower case where they and numbers are all of it, if the tokenizer does so too, so that
    a word's chunks share one entry; a word seen before needs no second look.

    New words go through the tokenizer's model together, as one text.  Where its vocabulary is of bytes, its tokens mark the ends
    of words and its words are runs of letters, single numbers and runs of other characters (all tried out on
    construction), they are cut into those here and their ids are dealt to them by counting ends; else, and for the few
    words that this rule does not cover, word by word through its normalizer, pre-tokenizer and model.
    Words with an added token or unusual white space are encoded as they are.
    ``most`` bounds the remembered words (packed ids).
    """

    CLOSING = ".,;:!?)\""

    def __init__(self, path: str, most: int = 900_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the executor's cores have tasks of their own
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)", re.I)
        self.by_words = self.tokenizer.normalizer is not None and self.tokenizer.pre_tokenizer is not None
        self.words, self.ends = Remembered(most), None
        self.closing, self.alnum = np.zeros(256, bool), np.zeros(256, bool)
        self.alnum[[c for c in range(128) if chr(c).isalnum()]] = True
        ends, probes = ["ab.", "a1,", "x\""], ["ab1", "12", "a-b--c", "x.", "(y)", "Z9z", "a_b", "\u00e9t\u00e9", "\u00df\u00bd", "--", "\u20ac5", "a"]
        if self.by_words and not any(re.search(r"\w[^\w\s]", t) and t[-1] in self.CLOSING for t in added) and all(
                self._whole(x) == self._whole(x[:-1]) + self._whole(x[-1]) for x in ends):
            self.closing[list(self.CLOSING.encode())] = True
        self.lowers = self.by_words and all(self._whole(x) == self._whole(x.lower()) for x in ("AB", "Ab1", "QX", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if self.by_words and suffix:
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
            self.classes, self.characters = _classes(), _byte_characters()
            self.model = Tokenizer.from_file(path)
            self.model.normalizer, self.model.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
            if self._together(probes) != [self._whole(x) for x in probes]:
                self.ends = None

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        ids, ends = self.encode(pa.array(texts, pa.large_string()))
        return np.split(ids, ends[:-1]) if texts else []

    def _words(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Row and code of each word in the form that it is remembered by, and the words by code."""
        data, inside, offsets, first, end = spans_of(column, _BETWEEN)
        # the last byte of each chunk that is no closing punctuation: what follows it is a word of its own after a letter or number
        told = end - 1
        closed = np.flatnonzero(self.closing[data[told]])
        at = closed
        while len(at):
            told[at] -= 1
            at = at[told[at] >= first[at]]
            at = at[self.closing[data[told[at]]]]
        cut = closed[told[closed] >= first[closed]]
        cut = cut[self.alnum[data[told[cut]]]]
        first, end = np.insert(first, cut + 1, told[cut] + 1), np.insert(end, cut, told[cut] + 1)
        words, length = data[inside], end - first
        if self.lowers:
            stops, mixed = np.cumsum(length), np.zeros(len(length) + 1, bool)
            mixed[np.searchsorted(stops, np.flatnonzero(~self.alnum[words]), "right")] = True
            capitals = np.flatnonzero((words >= 0x41) & (words <= 0x5A))
            words[capitals[~mixed[np.searchsorted(stops, capitals, "right")]]] += 32
        code, words = coded(words, length)
        return np.searchsorted(offsets, first, "right") - 1, code, listed(words)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every row of a text column, each with the end id, as one array, and where the rows end."""
        row, code, words = self._words(column)
        new = self.words.missing(set(words))
        for at in range(0, len(new), 1 << 13):  # the tokenizer's work space is many times its text
            self._learn(new[at:at + (1 << 13)])
        known = [*map(self.words.young.__getitem__, words), np.array([END_ID], "<u4").tobytes()]
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        count = np.bincount(row, minlength=len(column)) + 1
        code = np.insert(code, np.cumsum(count - 1), len(words))  # the end id stands after a row's last word
        take = expand((np.cumsum(size) - size)[code], size[code])[1]
        ends = np.cumsum(size[code])[np.cumsum(count) - 1]
        return np.frombuffer(b"".join(known), "<u4")[take], ends

    def _learn(self, asked: list[bytes]) -> None:
        known, words = self.words.young, [w.decode("utf-8", "replace") for w in asked]
        joined = " ".join(words)
        odd = set()
        if not self.by_words:
            odd = set(words)
        elif len(joined.split()) != len(words) or self.added.search(joined):
            odd = {w for w in words if len(w.split()) != 1 or self.added.search(w)}
        if odd:
            listed = list(odd)
            found = {w: np.array(e.ids, "<u4").tobytes() for w, e in zip(listed, self.tokenizer.encode_batch_fast(listed, add_special_tokens=False))}
            known.update((a, found[w]) for a, w in zip(asked, words) if w in odd)
            asked, words = (list(x) for x in zip(*[(a, w) for a, w in zip(asked, words) if w not in odd])) if len(odd) < len(set(words)) else ([], [])
        if self.ends is not None and words:
            plain = [i for i, w in enumerate(words) if "'" not in w] if "'" in joined else range(len(words))
            found = self._together([words[i] for i in plain])
            if found is not None:
                known.update(zip([asked[i] for i in plain], found))
                rest = set(range(len(words))).difference(plain)
                asked, words = [asked[i] for i in rest], [words[i] for i in rest]
        known.update(zip(asked, self._by_word(words)))

    def _together(self, words: list[str]) -> list[bytes] | None:
        """Ids of words that the model takes as one text; None where the rule does not cover them."""
        if not words:
            return []
        points = np.frombuffer(self.tokenizer.normalizer.normalize_str(" ".join(words)).encode("utf-32-le", "surrogatepass"), "<u4")
        if points.max() >= 1 << 16:
            return None
        kind = self.classes[points]
        if (kind == 4).any() or np.count_nonzero(kind == 0) != len(words) - 1:
            return None
        before = np.concatenate(([0], kind[:-1]))
        starts = (kind != 0) & ((kind == 2) | (kind != before))
        spaces = np.concatenate((np.flatnonzero(kind == 0), [len(kind)]))
        parts = np.cumsum(starts)[spaces - 1]  # the tokenizer's words up to the end of each of ours
        if (np.diff(parts, prepend=0) <= 0).any():
            return None
        apart = np.insert(points, np.flatnonzero(starts & (before != 0)), 0x20)
        mapped = self.characters[np.frombuffer(apart.tobytes().decode("utf-32-le").encode(), np.uint8)]
        ids = np.array(self.model.encode_batch_fast([mapped.tobytes().decode("utf-32-le")], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != parts[-1] or ends[-1] != len(ids):
            return None
        data, cut = ids.tobytes(), (4 * ends[parts - 1]).tolist()
        return [data[a:b] for a, b in zip([0, *cut], cut)]

    def _by_word(self, words: list[str]) -> list[bytes]:
        if not words:
            return []
        normal = self.tokenizer.normalizer.normalize_str(" ".join(words))
        if normal.count(" ") != len(words) - 1:  # a character became white space
            return [self._whole(w) for w in words]
        ends = np.cumsum(np.fromiter(map(len, normal.split(" ")), np.int64, len(words)) + 1)
        found = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)
        owner = np.searchsorted(ends, np.fromiter((at[0] for _, at in found), np.int64, len(found)), "right")
        first = np.searchsorted(owner, np.arange(len(words) + 1)).tolist()
        tokenize = self.tokenizer.model.tokenize
        ids = [np.array([t.id for t in tokenize(part)], "<u4").tobytes() for part, _ in found]
        return [b"".join(ids[a:b]) for a, b in zip(first, first[1:])]


_ENCODERS: dict[tuple[str, int], ChunkEncoder] = {}


def _groups(keys: np.ndarray, part: int, copies: dict[int, int], groups: int) -> np.ndarray:
    """The group of each row, from its key, its task and how many rows of that key the task has met."""
    number = np.empty(len(keys), np.uint64)
    for i, k in enumerate(keys.tolist()):
        number[i] = copies[k] = copies.get(k, -1) + 1
    x = keys.view(np.uint64) ^ np.uint64(part * 0x9E3779B97F4A7C15 % 2 ** 64) ^ ((number + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F))
    x = (x ^ x >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ x >> np.uint64(29)) % np.uint64(groups)).astype(np.int64)


def _tokenise(batches, path: str, length: int, with_ids: bool, remembered: int, groups: int):
    if (path, remembered) not in _ENCODERS:
        _ENCODERS[path, remembered] = ChunkEncoder(path, remembered)
    encoder = _ENCODERS[path, remembered]
    copies: dict[int, int] = {}
    part = TaskContext.get().partitionId()
    for batch in sliced(batches, "text", 256 << 10):
        group = _groups(batch.column(2).to_numpy(), part, copies, groups)
        rows, starts, sizes, totals, crcs, ids = [], [], [], [], [], []
        flat, ends = encoder.encode(batch.column(3))
        for row, (first, last) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
            tokens = flat[first:last]
            for start in range(0, len(tokens), length):
                piece = tokens[start:start + length]
                rows.append(row)
                starts.append(start)
                sizes.append(len(piece))
                totals.append(len(tokens))
                crcs.append(zlib.crc32(piece.tobytes()))
                if with_ids:
                    ids.append(piece.astype(np.int32))
        take = pa.array(rows, pa.int32())
        columns = [batch.column(0).take(take), batch.column(1).take(take), pa.array(group).take(take), pa.array(starts, pa.int64()),
                   pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64()), pa.array(totals, pa.int64())]
        names = ["id", "h", "grp", "start", "length", "ids_crc32", "doc_tokens"]
        if with_ids:
            columns.append(pa.array(ids, pa.list_(pa.int32())))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(columns, names=names)


def first_fit(sizes: list[int], room: int) -> list[int]:
    """The bin of each size, in the order given, by a tournament tree of the bins' room."""
    leaves = 1
    while leaves < len(sizes):
        leaves *= 2
    tree = [room] * (2 * leaves)
    bins = []
    for size in sizes:
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins.append(node - leaves)
        tree[node] -= size
        while node > 1:
            node //= 2
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left > right else right
    return bins


def _pack(length: int):
    def pack(key, pieces):
        order = [("length", "descending"), ("id", "ascending"), ("h", "ascending"), ("start", "ascending")]
        pieces = pieces.take(pc.sort_indices(pieces.select(["length", "id", "h", "start"]), order))
        sizes = pieces["length"].to_pylist()
        bins = np.array(first_fit(sizes, length), np.int64)
        filled = np.zeros(int(bins.max()) + 1, np.int64)
        offsets = np.empty(len(bins), np.int64)
        for i, (b, s) in enumerate(zip(bins.tolist(), sizes)):
            offsets[i] = filled[b]
            filled[b] += s
        sequence = (np.int64(key[0].as_py()) << np.int64(32)) + bins
        return pieces.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offsets))

    return pack


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 2048,
                   tokenizer: str | None = None, with_ids: bool = False, group_bytes: int = 12 << 20,
                   remembered: int = 900_000) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids: array<int>).

    ``remembered`` bounds the encoder's memory (chunks and words, about 200 bytes each) in every worker.
    """
    spark = docs.sparkSession
    prepared(spark)
    total = docs.agg(F.sum(F.octet_length(F.col(text_col)) + 1)).first()[0] or 0
    groups = 1 + total // group_bytes
    rows = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("h"), F.col(text_col).alias("text"))
    rows = rows.select("id", "h", F.xxhash64(F.lit("pack"), "id", "h").alias("grp"), "text")
    schema = T.StructType([rows.schema["id"], T.StructField("h", T.LongType()), T.StructField("grp", T.LongType())])
    for name in ("start", "length", "ids_crc32", "doc_tokens"):
        schema = schema.add(name, "long")
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    path = tokenizer or default_tokenizer()
    pieces = rows.mapInArrow(functools.partial(_tokenise, path=path, length=length, with_ids=with_ids, remembered=remembered, groups=groups), schema)
    out = T.StructType(list(schema.fields)).add("sequence_id", "long").add("offset", "long")
    packed = pieces.groupBy("grp").applyInArrow(_pack(length), out)
    columns = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    return packed.select(F.col("id").alias(id_col), *columns)


def build_sequences(packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per sequence from pieces with ids: sequence_id, ids (unpadded), docs (pieces in order)."""
    piece = F.struct("offset", F.col(id_col).alias("id"), "start", "length", "ids")
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(piece)).alias("p"))
    return rows.select("sequence_id", F.flatten("p.ids").alias("ids"),
                       F.transform("p", lambda x: x.dropFields("ids")).alias("pieces"))
