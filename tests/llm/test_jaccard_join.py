import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from tessera.llm import jaccard_join as J

from .conftest import ODD


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    k = min(width, len(words))
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def linked(x, y, percent):
    return bool(x and y) and 100 * len(x & y) >= percent * len(x | y)


def brute(rows, percent):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if linked(sets[i], sets[j], percent):
            parent[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted(((d, len(s), least.get(top(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


@pytest.fixture(scope="module")
def rows():
    """Copies with changed words and a shared passage, a chain of near copies, and odd rows."""
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(400)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, texts = some(40), []
    for _ in range(30):
        first = some(rng.choice([3, 4, 6, 9, 12, 40, 60, 200]))
        for _ in range(rng.choice([1, 2, 6])):
            words = list(first)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                at = rng.randrange(len(words))
                words[at:at + rng.choice([0, 1])] = some(1)
            texts.append(" ".join(words + passage * (rng.random() < 0.3)))
    chain = some(60)
    for k in range(30):
        chain = [f"z{k}" if i == k * 7 % 60 else w for i, w in enumerate(chain)]
        texts.append(" ".join(chain))
    return list(enumerate(texts, 1000)) + [(None, texts[3]), (5003, "a b c d e f g"), (5003, "a b\tc D e f  G")] + ODD


def run(docs, **kw):
    return sorted((tuple(r) for r in J.near_duplicates(docs, **kw).collect()), key=str)


def test_against_brute_force(docs_of, rows):
    assert run(docs_of(rows)) == brute(rows, 80)


@pytest.mark.parametrize("percent,kw", [(80, dict(tile_rows=3, block_shingles=2000, part_bytes=100_000)), (50, dict(tile_rows=5))])
def test_small_blocks_parts_and_tiles(docs_of, rows, percent, kw):
    assert run(docs_of(rows), percent=percent, **kw) == brute(rows, percent)


def test_every_pair_of_unequal_texts(docs_of, rows):
    texts = sorted({t for _, t in rows if shingles(t)})
    digest = {t: hashlib.md5(t.encode()).digest() for t in texts}
    want = {frozenset((digest[a], digest[b])): len(shingles(a) & shingles(b)) for a, b in itertools.combinations(texts, 2)
            if linked(shingles(a), shingles(b), 80)}
    got = J.similar_pairs(docs_of(rows), tile_rows=7).collect()
    assert {frozenset((bytes(r.digest_a), bytes(r.digest_b))): r.common for r in got} == want and len(got) == len(want)


def test_no_rows_and_wrong_percent(docs_of):
    assert run(docs_of([])) == []
    assert run(docs_of([(1, None), (2, "")])) == [(1, 0, 1), (2, 0, 2)]
    with pytest.raises(ValueError):
        J.near_duplicates(docs_of([]), percent=0)


def test_many_variants_of_one_text(docs_of):
    """Hundreds of near copies: links are found without verifying every pair."""
    rng = random.Random(5)
    first = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join("x%d" % i if k == rng.randrange(150) else w for k, w in enumerate(first))) for i in range(300)]
    got = run(docs_of(rows), tile_rows=64)
    assert got == brute(rows, 80)


@pytest.mark.parametrize("percent", [50, 80, 93, 100])
def test_bands_hold_linked_sizes_side_by_side(percent):
    edges = J._edges(percent)
    n = np.arange(1, 3000)
    assert (np.searchsorted(edges, n * 100 // percent, "right") <= np.searchsorted(edges, n, "right") + 1).all()


@pytest.mark.parametrize("wide", [1, 8])
def test_bitmaps_never_lose_a_pair(wide):
    """The bound is not below the real overlap, whatever widths the two bitmaps have."""
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 56, 500, np.uint64)
    sets = [np.sort(rng.choice(pool, n, replace=False)) for n in rng.integers(1, 400, 60)]
    sets += [np.sort(np.unique(np.concatenate((s[len(s) // 12:], rng.integers(0, 1 << 56, 3, np.uint64))))) for s in sets]
    sets.sort(key=len)
    n, every = np.array([len(s) for s in sets]), np.ones(len(sets), bool)
    bits = [J._bitmap(s, J._width(wide * len(s))) for s in sets]
    found = list(J._passing(np.zeros(len(sets), np.int64), n, n, bits, every, 80, lambda a, b: np.ones(len(a), bool), block=50))
    passed = {(a, b): k for x, y, bound in found for a, b, k in zip(x.tolist(), y.tolist(), bound.tolist())}
    assert all(len(np.intersect1d(sets[a], sets[b])) <= k for (a, b), k in passed.items())
    links = {(a, b) for a in range(len(sets)) for b in range(a) if linked(set(sets[a].tolist()), set(sets[b].tolist()), 80)}
    assert links <= set(passed) and len(links) > 30 and len(passed) < len(sets) * (len(sets) - 1) / 4
