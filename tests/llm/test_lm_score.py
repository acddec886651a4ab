import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.llm import lm_score

from .conftest import ODD


def brute(rows, train):
    texts = [((t or "").encode().lower().split() + [lm_score.END]) for _, t in rows]
    uni, bi, begins = Counter(), Counter(), 0
    for (i, _), ws in zip(rows, texts):
        if train(i):
            uni.update(ws)
            bi.update(zip([lm_score.BEGIN] + ws, ws))
            begins += 1
    n, v = sum(uni.values()), len(uni)
    out = []
    for (i, _), ws in zip(rows, texts):
        base = score = 0.0
        for u, w in zip([lm_score.BEGIN] + ws, ws):
            p = (uni[w] + 0.1) / (n + 0.1 * (v + 1))
            c = begins if u == lm_score.BEGIN else uni[u]
            base += math.log10(p)
            score += math.log10((bi[u, w] + lm_score.PRIOR * p) / (c + lm_score.PRIOR))
        out.append((i, train(i), len(ws), sum(uni[w] > 0 for w in ws), n, base, score))
    return out


@pytest.mark.parametrize("bucket_bytes,part_tokens", [(200, 50), (1 << 20, 1 << 20)])
@pytest.mark.parametrize("rows", ["random", ODD, []])
def test_against_brute_force(docs_of, rows, bucket_bytes, part_tokens):
    rnd = random.Random(4)
    if rows == "random":
        rows = [(i, " ".join(rnd.choice("a b c D dd É é f g".split()) for _ in range(rnd.randrange(30)))) for i in range(80)]
    out = lm_score.score_texts(docs_of(rows), F.col("doc_id") % 4 != 0, bucket_bytes=bucket_bytes, part_tokens=part_tokens)
    key = lambda r: (str(r[0]), r[2], r[5])
    got = sorted((tuple(r) for r in out.collect()), key=key)
    want = sorted(brute(rows, lambda i: i is not None and i % 4 != 0), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_probabilities_of_every_state_sum_to_one():
    """Over all words and one unknown, in a toy corpus."""
    import numpy as np

    counts, n, v = np.array([5.0, 3, 0]), 8, 2  # the last word stands for all unknown ones
    pairs = np.array([2.0, 0, 0])               # after word 0
    auto = lm_score.Automaton(pairs, counts, 1, n, v)
    p = 10 ** auto.root
    assert p.sum() == pytest.approx(1)
    seen = (pairs + lm_score.PRIOR * p) / (pairs.sum() + lm_score.PRIOR)
    assert seen.sum() == pytest.approx(1)


def test_held_out_text_is_likelier_than_by_words_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = lm_score.score_texts(docs, F.col("doc_id") % 10 != 0).filter("not train").agg(F.sum("base_score"), F.sum("score")).first()
    assert got[1] > got[0] * 0.95
