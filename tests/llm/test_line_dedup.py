import random

import pytest
from pyspark.sql import functions as F

from tessera.llm.common import text_hash
from tessera.llm.line_dedup import dedup_lines

from .conftest import ODD


def brute(rows, window=3):
    """rows: (id, text hash, text); the kept text of each."""
    seen, later = {}, {}
    keyed = sorted({(r[0] is not None, r[0] or 0, r[1], r[2]) for r in rows if r[2]}, key=lambda r: r[:3])
    for has, i, h, text in keyed:
        lines = text.split("\n")
        k = min(window, len(lines))
        for at in range(len(lines) - k + 1):
            win = tuple(lines[at:at + k])
            if not any(x.strip(" \t\n\r\x0b\x0c") for x in win):
                continue
            if win in seen:
                later.setdefault((has, i, h), set()).update(range(at, at + k))
            else:
                seen[win] = True
    out = []
    for i, h, text in rows:
        gone = later.get((i is not None, i or 0, h), set())
        out.append((i, text if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)))
    return sorted(out, key=str)


def check(docs):
    rows = [tuple(r) for r in docs.select("doc_id", text_hash("text"), "text").collect()]
    got = dedup_lines(docs)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == brute(rows)
    return got


def test_random_documents(docs_of):
    rnd = random.Random(3)
    check(docs_of([(i, "\n".join(rnd.choice("abcde") for _ in range(rnd.randrange(8)))) for i in range(120)]))


def test_odd_rows_and_columns(docs_of):
    got = check(docs_of(ODD))
    assert got.columns.count("n_lines") == 1 and dict(got.dtypes)["n_lines"] == "bigint" and "h" in got.columns


def test_spans_are_merged_and_first_copy_stays(docs_of):
    got = {r.doc_id: r for r in dedup_lines(docs_of([(1, "a\nb\nc\nd\ne"), (2, "z\na\nb\nc\nd\ny"), (3, "q\nq\nq\nq\nq")])).collect()}
    assert got[1].text == "a\nb\nc\nd\ne" and got[2].text == "z\ny" and got[2].removed_spans == [[1, 5]] and got[2].n_lines == 6
    assert got[3].text == "q"


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_empty_tables(docs_of, rows):
    assert dedup_lines(docs_of(rows)).count() == len(rows)


def test_long_repeated_passage_is_removed_everywhere_but_once(docs_of):
    passage = "\n".join(f"this is line number {i} of a passage that many documents share" for i in range(6))
    got = dedup_lines(docs_of([(i, f"own start {i}\n{passage}\nown end {i}") for i in range(40)]))
    assert got.filter(F.col("text").contains("line number")).count() == 1
    assert got.filter(F.col("text").startswith("own start") & F.col("text").contains("own end")).count() == 40
