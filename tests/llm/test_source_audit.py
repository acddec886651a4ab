import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import types as T

from tessera.llm import source_audit

SCHEMA = T.StructType().add("doc_id", "long").add("text", "string").add("lang", "string").add("source", "string") \
    .add("count", "string").add("Term", "string").add("n", "string").add("rank", "string")


def brute(rows, min_docs=30, top=50):
    counts, docs, in_lang = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    groups = defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        groups[lang].add(source)
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        for source in sources:
            in_lang[lang].update({t: counts[lang, source][t] for t in kept})
        share = {}
        for who, c in [*((s, counts[lang, s]) for s in sources), (None, in_lang[lang])]:
            over = sum(c[t] for t in kept) + 5 * len(kept)
            share[who] = [1 + 1_000_000_000 * (c[t] + 5) // over for t in kept]
        for s in sources:
            pairs = sorted((-sum(abs(p - q) for p, q in zip(share[s], share[o])), o.encode(), o) for o in sources if o != s)
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(pairs)]
            terms = sorted((q - p, t.encode(), t) for t, p, q in zip(kept, share[s], share[None]) if counts[lang, s][t] and p > q)
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(terms[:top])]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, *r, "x", "x", "x", "x") for i, r in enumerate(rows)], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in source_audit.divergence(df, **kw).collect())


@pytest.fixture(scope="module")
def rows():
    """Two languages, one source with a third of all rows, sources without terms, nulls, ties, a long text, one lonely language."""
    rng = random.Random(4)
    words = [f"{a}{b}" for a in "abcdé" for b in "xyzßü"] + ["Ab", "AB"]
    out = []
    for i in range(260):
        source = "hot" if i % 3 == 0 else f"s{rng.randrange(9)}"
        favour = words[hash(source[-1]) % 7::3]
        out.append((" ".join(rng.choice(favour if rng.random() < 0.3 else words) + rng.choice(["", "1", "-q", "."]) for _ in range(rng.randrange(1, 14))),
                    rng.choice(["en", "de", None]), source))
    out += [(None, "en", "none"), ("", "en", "empty"), ("12 34 !", "de", "digits"), ("solo " * 40, "xx", "one"), (None, None, None), ("ax by", "en", None)]
    return out + out[:30] + [("ax " * 30_000, "de", "long"), ("Kelvin K K İx", "de", "ß")]


@pytest.mark.parametrize("min_docs,kw", [(30, {}), (3, dict(block=2, range_terms=3)), (1, dict(block=1, range_terms=10, top=4))])
def test_against_brute_force(spark, rows, min_docs, kw):
    assert run(spark, rows, min_docs=min_docs, **kw) == brute(rows, min_docs, kw.get("top", 50))


def test_no_rows_and_no_kept_terms(spark):
    assert run(spark, []) == []
    rows = [("a b", "en", "x"), ("a", "en", "y"), ("a", "fr", "z")]
    assert run(spark, rows) == brute(rows) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def test_shares_are_exact_beyond_doubles():
    import numpy as np

    counts = np.array([0, 1, 7, 10**12 + 7, 9 * 10**14])
    for total, terms in ((10**15 + 3, 10**6 + 1), (10**15, 1), (9 * 10**15 // 10, 3)):
        got = source_audit._shares(counts, total, terms, 5, 10**9).tolist()
        assert got == [1 + 10**9 * (c + 5) // (total + 5 * terms) for c in counts.tolist()]
