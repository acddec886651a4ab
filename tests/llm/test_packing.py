import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import packing

from .conftest import ODD

PATH = packing.default_tokenizer()


TOKENIZER = Tokenizer.from_file(PATH)


def whole_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


def naive_first_fit(sizes, room):
    bins, out = [], []
    for s in sizes:
        k = next((i for i, r in enumerate(bins) if r >= s), len(bins))
        if k == len(bins):
            bins.append(room)
        bins[k] -= s
        out.append(k)
    return out


def test_tournament_tree_is_first_fit():
    rnd = random.Random(1)
    for n in (1, 2, 3, 100, 257):
        sizes = [rnd.randrange(1, 65) for _ in range(n)]
        assert packing.first_fit(sizes, 64) == naive_first_fit(sizes, 64)


def test_ids_by_chunks_are_the_ids_of_the_whole_text():
    texts = ["", " a b  c d\x1ce\x85f ", "Don't <|endoftext|>stop<|startoftext|> it's 1234 x²  ñ́ é ́a", "İstanbul ΣΑΣ ﬁ \r\n\t\x0b end", "a" * 500, "日本語 テキスト 🎉👩‍👩‍👧"]
    rnd = random.Random(8)
    texts += ["a\x85b c\u2028d", "x\u0301 \u0301y q\ufdfa \u00a0\u3000z", "<|STARTOFTEXT|> it'S'll 've", "the The THE tHe. the, 'the'"]
    texts += ["".join(chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(160, 0x500), rnd.randrange(0x2000, 0x2100), 32, 10, 9])) for _ in range(300)) for _ in range(60)]
    encode = packing.ChunkEncoder(PATH, most=200)
    for t, ids in zip(texts, encode(texts)):
        assert ids.tolist() == whole_ids(t)


def check(docs, rows, **kw):
    packed = packing.pack_documents(docs, with_ids=True, **kw).collect()
    length = kw.get("length", 2048)
    by_seq, by_doc = {}, {}
    for r in packed:
        assert r.length == len(r.ids) > 0 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_seq.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    want = sorted((str(i), whole_ids(t)) for i, t in rows)
    got = []
    for (i, n), pieces in by_doc.items():
        copies = sum(r.start == 0 for r in pieces)
        pieces.sort(key=lambda r: r.start)
        if copies == 1:
            got.append((str(i), [x for r in pieces for x in r.ids]))
        else:
            assert len(pieces) % copies == 0
            got += [(str(i), [x for r in pieces[::copies] for x in r.ids])] * copies
    assert sorted(got) == want
    return len(by_seq), sum(len(ids) for _, ids in want)


def test_random_documents_fill_their_sequences(docs_of):
    rnd = random.Random(6)
    rows = [(i, " ".join(rnd.choice("the and of to stories table x9 émile".split()) for _ in range(rnd.choice([0, 5, 40, 300])))) for i in range(400)]
    sequences, tokens = check(docs_of(rows), rows, length=128)
    assert sequences <= 1 + 1.05 * tokens / 128
    check(docs_of(rows), rows, length=128, group_bytes=4000)


@pytest.mark.parametrize("rows", [ODD, []])
def test_odd_rows(docs_of, rows):
    check(docs_of(rows), rows)


def test_sequences_hold_their_pieces_in_order(docs_of):
    packed = packing.pack_documents(docs_of([(i, "a few words " * i) for i in range(60)]), length=64, with_ids=True)
    sequences = packing.build_sequences(packed)
    assert sequences.agg(F.sum(F.size("ids"))).first()[0] == packed.agg(F.sum("length")).first()[0]
    for r in sequences.collect():
        assert [p.offset for p in r.pieces] == sorted(p.offset for p in r.pieces) and len(r.ids) <= 64


def test_every_chunk_form_has_the_ids_of_the_whole_text():
    """Case, closing punctuation, contractions, characters that change under normalisation, and a small memory."""
    from tokenizers import Tokenizer

    texts = ["Don't DON'T it's' 'tis o'clock's", "\u0130stanbul \u015e\u015e \ufb01ne \u00bdx x\u00bd \u2167 \u2460\u2461", "nai\u0308ve \u0301a x\u200bx  y\u3000z a\x1cb a\x85b",
             "<|endoftext|> <|ENDOFTEXT|>x a<|startoftext|>b", "a,b,c!!! ...x (\"quoted.\") 'q' \u212a K \u017fs H\u0331 T\u0308.", "\U0001d518 \U0001f600x 12abc34 3.14 1,000.00",
             "", " ", "\n\t x", "don\u2019t \u201cx\u201d \u2014", "\u03a3\u0391\u03a3 \u039f\u0394\u039f\u03a3.", "\x00a\x01b x</w> </w> a</w>b", "Word word. WORD, word! wOrd"]
    whole = Tokenizer.from_file(packing.default_tokenizer())
    want = [[*whole.encode(t, add_special_tokens=False).ids, packing.END_ID] for t in texts]
    for most in (900_000, 6):
        encoder = packing.ChunkEncoder(packing.default_tokenizer(), most)
        assert encoder.ends is not None
        for _ in range(2):
            assert [list(ids) for ids in encoder(texts)] == want
            assert [list(encoder([t])[0]) for t in texts] == want
        encoder.ends = None  # word by word
        encoder.words = packing.Remembered(most)
        assert [list(ids) for ids in encoder(texts)] == want


def test_a_repeated_row_is_spread_over_groups(spark, docs_of):
    """One row that is a third of the table does not gather in one group."""
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice(["ab", "cde", "f"], 40))) for i in range(600)] + [(7, "the same row again and again " * 8)] * 300
    packed = packing.pack_documents(docs_of(rows), group_bytes=8_000)
    per_group = packed.filter("doc_id = 7").groupBy((F.col("sequence_id") / 2 ** 32).cast("long").alias("g")).count().collect()
    total = packed.count()
    assert sum(r["count"] for r in per_group) >= 300 and len(per_group) >= 8 and max(r["count"] for r in per_group) < total / 4
    filled = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r.n == r.end <= 2048 for r in filled)
