import random

import numpy as np
import pytest
import xxhash

from tessera.llm import simhash
from tessera.llm.components import connected_components

from .conftest import ODD


def plain_fingerprint(text, words=3):
    ws = (text or "").encode().lower().split()
    sh = [b" ".join(ws[i:i + words]) for i in range(len(ws) - words + 1)] or ([b" ".join(ws)] if ws else [])
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(fps, bits=2):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= bits:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(fps))]


def test_code_is_perfect():
    error, reach, bits, offsets = simhash._golay(2)
    words = np.random.default_rng(1).integers(0, 1 << 23, 5000)
    home, _ = simhash._homes(words, 2)
    assert (simhash._syndrome(home) == 0).all() and np.bitwise_count(home ^ words).max() == 3
    assert np.diff(offsets).max() <= 22 + 8


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_every_close_pair_meets_at_a_home(bits):
    rng = np.random.default_rng(bits)
    base = rng.integers(0, 1 << 64, 300, dtype=np.uint64)
    for flips in range(bits + 1):
        other = base.copy()
        for row in range(len(base)):
            for b in rng.choice(64, flips, replace=False):
                other[row] ^= np.uint64(1) << np.uint64(b)
        r1, a1, h1 = simhash.replicas(base, bits)
        homes = np.empty(len(base), np.int64)
        homes[r1[h1]] = a1[h1]
        r2, a2, _ = simhash.replicas(other, bits)
        assert len(set(np.unique(r2[a2 == homes[r2]]))) == len(base)


def test_forest_equals_all_pairs_both_ways():
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    fps = sorted({centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for _ in range(700)})
    fp = np.array(fps, np.uint64)
    anchor, home = np.zeros(len(fp), np.int32), np.ones(len(fp), bool)
    want = plain_components(fps)
    for function in ("_close", "_neighbours"):
        if function == "_close":
            a, b = simhash._forest(anchor, fp, home, 2)
        else:
            x, y = (np.concatenate(z) for z in zip(*simhash._neighbours(fp, home, 2)))
            label = simhash.roots(len(fp), x, y)
            a, b = fp, fp[label]
        index = {int(f): i for i, f in enumerate(fps)}
        edges = [(index[int(p)], index[int(q)]) for p, q in zip(a, b)]
        label = simhash.roots(len(fps), np.array([e[0] for e in edges]), np.array([e[1] for e in edges]))
        assert label.tolist() == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 1000 + i) for i in range(50)] + [(5, 5), (1010, 2000), (2000, 3)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(101, 161))
    assert all(got[n] == 3 for n in [7, 2000, *range(1000, 1050)]) and 5 not in got
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_copies():
    rnd = random.Random(11)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(4)) for _ in range(400)]
    rows = []
    for g in range(12):
        base = [rnd.choice(words) for _ in range(rnd.choice([2, 3, 40, 200]))]
        for _ in range(12):
            w = list(base)
            for _ in range(rnd.randrange(3)):
                w[rnd.randrange(len(w))] = rnd.choice(words)
            rows.append((len(rows), " ".join(w) + rnd.choice(["", "\n", "  "])))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows", [near_copies(), [r for r in ODD if r[0] is not None], []])
def test_against_brute_force(docs_of, rows):
    got = simhash.near_duplicates(docs_of(rows)).collect()
    rows = sorted(rows, key=str)
    fps = [plain_fingerprint(t) for _, t in rows]
    assert sorted((r.doc_id, r.fp & (1 << 64) - 1) for r in got) == sorted((i, f) for (i, _), f in zip(rows, fps))
    classes = plain_components(fps)
    least = {}
    for (i, _), c in zip(rows, classes):
        least[c] = min(i, least.get(c, i))
    assert sorted((r.doc_id, r.component_id) for r in got) == sorted((i, least[c]) for (i, _), c in zip(rows, classes))


def test_one_document_of_each_component_stays(docs_of):
    rows = near_copies() + ODD
    docs = docs_of(rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    classes = plain_components([plain_fingerprint(t) for _, t in rows])
    want = {}
    for (i, _), c in zip(rows, classes):
        want[c] = min((i is None, i or 0), want.get(c, (True, 1 << 60)))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted(want.values())
