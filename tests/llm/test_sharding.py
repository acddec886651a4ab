import os

import pytest
from pyspark.sql import functions as F

from tessera.llm.sharding import shard_by_bytes, write_shards

from .conftest import ODD

def size():
    return F.coalesce(F.octet_length("text"), F.lit(0)) + 1


def check(docs, n):
    out = shard_by_bytes(docs, n, size(), ["doc_id"])
    assert out.columns == [c for c in docs.columns if c != "shard"] + ["shard", "slot"]
    rows = out.select("doc_id", "shard", "slot", size().alias("size")).collect()
    assert len(rows) == docs.count()
    rows.sort(key=lambda r: (r.shard, r.slot))
    by = {}
    for r in rows:
        assert r.slot == len(by.setdefault(r.shard, []))
        by[r.shard].append(r.size)
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in rows]
    assert keys == sorted(keys)  # contiguous
    if rows:
        target, most = sum(r.size for r in rows) / n, max(r.size for r in rows)
        assert all(abs(sum(by.get(s, [])) - target) <= most + n for s in range(n))
        assert all(0 <= s < n for s in by)


@pytest.mark.parametrize("n", [1, 3, 8])
def test_balanced_contiguous_gapless(docs_of, n):
    check(docs_of([(i * 7919 % 500, "x" * (i * i % 97)) for i in range(500)]), n)


@pytest.mark.parametrize("rows", [ODD, [], [(5, "same")] * 300, [(None, None)]])
def test_odd_tables(docs_of, rows):
    check(docs_of(rows), 8)


def test_written_shards(spark, docs_of, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "shards")
    write_shards(shard_by_bytes(docs_of([(i, "abc") for i in range(64)]), 4, size(), ["doc_id"]), path)
    assert {r.shard: r["count"] for r in spark.read.parquet(path).groupBy("shard").count().collect()} == {0: 16, 1: 16, 2: 16, 3: 16}
