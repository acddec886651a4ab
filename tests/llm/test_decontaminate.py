import random

import pytest

from tessera.llm import decontaminate as dc

from .conftest import ODD


def brute(text, items, window):
    ws = dc.words_of((text or "").encode())
    hit, names = [False] * len(ws), set()
    for name, item in items:
        iw = dc.words_of((item or "").encode())
        k = min(window, len(iw))
        wins = {tuple(iw[i:i + k]) for i in range(len(iw) - k + 1)} if k else set()
        for i in range(len(ws) - k + 1 if k else 0):
            if tuple(ws[i:i + k]) in wins:
                hit[i:i + k] = [True] * k
                names.add(name)
    return len(ws), sum(hit), sorted(str(n) for n in names if n is not None)


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, extra string")


@pytest.mark.parametrize("block_words", [5, 30, 40_000])
def test_against_brute_force(spark, docs_of, block_words):
    rnd = random.Random(block_words)
    letters = "a b c d e".split()
    items = [(i, " ".join(rnd.choice(letters) for _ in range(rnd.choice([1, 3, 4, 5, 9, 30])))) for i in range(3, 14)]
    items = [i for i in items if len(i[1].split()) > 2] + [(1, None), (2, ""), (3, items[0][1]), (None, "e e e e a a a a"), (40, "Zz, É-ü; 7")]
    docs = [(i, rnd.choice([" ", "-", "\n"]).join(rnd.choice(letters + ["q"]) for _ in range(rnd.randrange(60)))) for i in range(150)]
    docs += ODD + [(777, "so zz É ü 7 is"), (778, "zz é ü 7")]
    out = dc.find_leaks(docs_of(docs), items_of(spark, items), window=4, block_words=block_words)
    assert out.columns.count("items") == 1
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in out.collect()), key=str)
    assert got == sorted(((i, *brute(t, items, 4)) for i, t in docs), key=str)


def test_clean_cuts_until_nothing_is_hit_and_drops_the_covered(spark, docs_of):
    item = "one two three four five six seven eight nine ten eleven"
    docs = [(1, f"A start. {item.upper()}, and an END of more words than there were in it, so that it stays as it is."), (2, item), (3, None), (4, "clean  text\n\n"),
            (5, "w " * 30 + "one two three four five " + item + " six seven eight nine ten eleven" + " w" * 30)]
    out = dc.clean(docs_of(docs), items_of(spark, [(9, item)]))
    got = {r.doc_id: r.text for r in out.collect()}
    assert set(got) == {1, 3, 4, 5} and got[3] is None and got[4] == "clean  text\n\n"
    assert got[1] == "A start.\nand an END of more words than there were in it, so that it stays as it is."
    assert all(brute(t, [(9, item)], 10)[1] == 0 for t in got.values()) and out.columns == docs_of([]).columns
    assert {r.doc_id for r in dc.clean(docs_of(docs), items_of(spark, [(9, item)]), max_hit_words=5).collect()} == {3, 4}


def test_empty_tables(spark, docs_of):
    assert dc.find_leaks(docs_of([]), items_of(spark, [(1, "a b")])).count() == 0
    assert all(r.n_hit == 0 and r["items"] == [] for r in dc.find_leaks(docs_of(ODD), items_of(spark, [])).collect())
